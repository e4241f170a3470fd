"""DuckDB SQL of the queries that plain SQL can express, built on the patterns of the Spark side.

p1, p2, p4, p5, p6 and p9 have none: they rest on similarity scores, parsed text, HTML and a seeded choice.
"""

from __future__ import annotations

from sitegrain.llm import p7_lookalike as looks
from sitegrain.llm.p2_residue import DUMMY_STREET, EMPTY_VALUE, FILLER_VALUE, MESSAGE_VALUE, SLOT_VALUE


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _dummy(v: str) -> str:
    tests = [f"regexp_matches({v}, {_quoted(SLOT_VALUE)})", *(f"regexp_matches(lower({v}), {_quoted(p)})" for p in (EMPTY_VALUE, FILLER_VALUE, MESSAGE_VALUE))]
    return "(" + " OR ".join(tests) + ")"


# RE2 has no back-references: the runs of one digit are written out.
SAME_DIGIT = "|".join(f"{d}{{2,}}" for d in range(10))
FAKE_NUMBER = rf"^({SAME_DIGIT}|1234567890|0123456789|9876543210|1?234567)$|0{{7}}$|^\d{{3}}555\d{{4}}$|^555\d{{4}}$|^555\d{{7}}$"

P3_FOUND = rf"""
WITH keyed AS (
  SELECT ord, domain, confidence, crawled_at,
         trim(coalesce(address_street, '')) AS street, trim(coalesce(address_zip, '')) AS zip, trim(coalesce(phone, '')) AS phone,
         regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce(source_url, ''))), '[?#].*$', ''), '^[a-z][a-z0-9+.-]*://', ''), '^www\.|/+$', '', 'g') AS page
  FROM locations WHERE domain IS NOT NULL
), own AS (
  SELECT *, min(ord) OVER (PARTITION BY domain, page) AS group_ord, count(*) OVER (PARTITION BY domain, page) AS n
  FROM keyed WHERE regexp_matches(page, '^[^/]*/+[^/]+/+[^/]')
), digits AS (
  SELECT *, regexp_replace(regexp_replace(lower(phone), '(ext|x)\.?\s*\d+$', ''), '[^0-9]', '', 'g') AS d FROM own WHERE n >= 2
), number AS (
  SELECT *, CASE WHEN length(d) = 11 AND d LIKE '1%' THEN substr(d, 2, 10) ELSE d END AS num FROM digits
), claims AS (
  SELECT 'address_street' AS field_name, group_ord, ord, confidence, crawled_at FROM number
  WHERE street <> '' AND NOT {_dummy("street")} AND NOT regexp_matches(lower(street), {_quoted(DUMMY_STREET)})
  UNION ALL SELECT 'address_zip', group_ord, ord, confidence, crawled_at FROM number WHERE zip <> '' AND NOT {_dummy("zip")}
  UNION ALL SELECT 'phone', group_ord, ord, confidence, crawled_at FROM number
  WHERE phone <> '' AND NOT {_dummy("phone")} AND NOT regexp_matches(num, '{FAKE_NUMBER}') AND length(num) >= 7
), ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY field_name, group_ord
    ORDER BY CASE lower(trim(coalesce(confidence, ''))) WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 WHEN 'not_found' THEN 3 ELSE 4 END, crawled_at DESC NULLS LAST, ord) AS k
  FROM claims
)
SELECT field_name, group_ord, ord FROM ranked WHERE k = 1
"""


def _look(c: str) -> str:
    """The mapping of p7 with composed accents, which its collation equates."""
    source = "".join(looks.WIDTH) + looks.CYRILLIC + looks.GREEK + looks.SPACES + looks.HYPHENS + "".join(looks.SINGLE)
    target = "".join(looks.WIDTH.values()) + looks.CYRILLIC_TWIN + looks.GREEK_TWIN + " " * len(looks.SPACES) + "-" * len(looks.HYPHENS) + "".join(looks.SINGLE.values())
    out = f"translate(regexp_replace({c}, {_quoted(looks.INVISIBLE + '|[\uffa0\u3164]')}, '', 'g'), {_quoted(source)}, {_quoted(target)})"
    for one, many in (looks.LIGATURES | looks.ROMAN).items():
        out = f"replace({out}, '{one}', '{many}')"
    return f"nfc_normalize(trim(regexp_replace({out}, '[ \\t\\r\\n]+', ' ', 'g')))"


_SNIPPETS = "SELECT 'location' AS field_name, domain, ord, snippet AS s FROM locations" + "".join(f" UNION ALL SELECT '{f}', domain, ord, {f}__snippet FROM orgs" for f in looks.FIELDS)
P7_FOUND = f"""
WITH a AS (SELECT field_name, domain, ord, s, {_look("s")} AS k FROM ({_SNIPPETS}) x WHERE trim(coalesce(s, '')) <> '' AND domain IS NOT NULL)
SELECT x.field_name, x.ord AS ord_a, y.ord AS ord_b FROM a x JOIN a y ON x.field_name = y.field_name AND x.domain = y.domain AND x.k = y.k AND x.s <> y.s AND x.ord < y.ord
"""

_RUNS = r"SELECT DISTINCT {id}, array_to_string(w[i:i + 11], ' ') AS run FROM (SELECT {id}, w, unnest(range(1, len(w) - 10)) AS i FROM (SELECT {id}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM {table} WHERE text IS NOT NULL) a) b"
P8_FOUND = f"""
WITH i AS ({_RUNS.format(id="item_id", table="eval_items")}), d AS ({_RUNS.format(id="doc_id", table="documents")})
SELECT DISTINCT item_id, doc_id FROM i JOIN d USING (run)
"""

P10_FOUND = """
WITH w AS (SELECT DISTINCT doc_id, md5(substr(text, i, 200)) AS k FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200) a),
r AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1), s AS (SELECT doc_id, k FROM w JOIN r USING (k))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id
"""

SQL = {"p3_found": P3_FOUND, "p7_found": P7_FOUND, "p8_found": P8_FOUND, "p10_found": P10_FOUND}
