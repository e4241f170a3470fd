"""Queries of addresses, postal codes and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions import addresses as ad
from sitegrain.functions.text import clean, is_blank, lower_trim
from sitegrain.operators import dedupe as dd
from sitegrain.operators.joins import best_match, shared_letters
from sitegrain.plans import sqltext as q
from sitegrain.plans.registry import query
from sitegrain.sources.tables import table


def _loc(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "locations").select("ord", *columns)


PLACE = ["domain", "location_name", "address_street", "address_city", "address_state", "address_zip", "phone"]


@query(f"SELECT ord, {q.norm_street('address_street')} AS street_key, {q.norm_street_bare('address_street')} AS street_bare FROM locations")
def street_keys(spark: SparkSession, d: str) -> DataFrame:
    """The comparison forms of a street, with and without its unit."""
    return _loc(spark, d, "address_street").select("ord", ad.norm_street("address_street").alias("street_key"), ad.norm_street("address_street", False).alias("street_bare"))


_ALL = ad.DIRECTIONS | ad.STREET_TYPES | ad.ROUTES
_KNOWN = ", ".join(q.quoted(k) for k in _ALL)
_FULL = " ".join(f"WHEN '{k}' THEN '{v.capitalize()}'" for k, v in _ALL.items())
_UNITS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ad.UNIT_NAMES.items())
_TITLE = r"CASE WHEN regexp_matches(lower({t}), '^\d+(st|nd|rd|th)$') THEN lower({t}) WHEN regexp_matches({t}, '\d') AND regexp_matches({t}, '[A-Za-z]') THEN upper({t}) ELSE upper(substr({t}, 1, 1)) || lower(substr({t}, 2)) END"
DISPLAY = rf"""
WITH a AS (
  SELECT ord, {q.tokens(r"regexp_replace(regexp_replace(regexp_replace(" + q.cl("address_street") + r", '\b(suite|ste)\.?\s*#\s*', 'Suite ', 'gi'), '#\s*', 'Suite ', 'g'), '[.,]', ' ', 'g')")} AS w FROM locations
), b AS (
  SELECT ord, w, list_min([i for i in range(1, len(w) + 1) if lower(w[i]) IN ({", ".join(q.quoted(k) for k in ad.UNIT_NAMES)})]) AS u FROM a
), c AS (
  SELECT ord, w, coalesce(u - 1 - CASE WHEN u > 1 AND lower(w[u]) IN ('floor', 'fl') AND regexp_matches(lower(w[u - 1]), '^\d+(st|nd|rd|th)$') THEN 1 ELSE 0 END, len(w)) AS m FROM b
), d AS (
  SELECT ord, w[1:m] AS main, [CASE lower(t) {_UNITS} ELSE {_TITLE.format(t="t")} END for t in w[m + 1:]] AS unit FROM c
)
SELECT ord, array_to_string([CASE WHEN lower(main[i]) = 'st' THEN CASE WHEN lower(main[i + 1]) IN ({", ".join(q.quoted(k) for k in ad.ROAD_WORDS)}) THEN 'State' WHEN main[i + 1] IS NULL OR lower(main[i + 1]) IN ({_KNOWN}) THEN 'Street' ELSE 'Saint' END
    ELSE CASE lower(main[i]) {_FULL} ELSE {_TITLE.format(t="main[i]")} END END for i in range(1, len(main) + 1)], ' ')
  || CASE WHEN len(unit) > 0 THEN ', ' || array_to_string([unit[i] for i in range(1, len(unit) + 1) if i = 1 OR lower(unit[i]) <> lower(unit[i - 1])], ' ') ELSE '' END AS shown
FROM d
"""


@query(DISPLAY)
def street_display(spark: SparkSession, d: str) -> DataFrame:
    """The street as it is shown."""
    return _loc(spark, d, "address_street").select("ord", ad.canonical_display("address_street").alias("shown"))


@query(f"SELECT ord, {q.sig_number('address_street')} AS number, {q.sig_word('address_street')} AS word FROM locations")
def street_signatures(spark: SparkSession, d: str) -> DataFrame:
    """House number and first street word."""
    return _loc(spark, d, "address_street").select("ord", ad.street_signature("address_street").alias("s")).select("ord", "s.*")


@query(rf"SELECT ord, trim(regexp_replace(coalesce(address_street, ''), '\b({'|'.join(ad.UNIT_WORDS)})\b.*$', '', 'is')) AS bare FROM locations")
def street_without_suite(spark: SparkSession, d: str) -> DataFrame:
    """T4: the street before its unit."""
    return _loc(spark, d, "address_street").select("ord", ad.strip_suite("address_street").alias("bare"))


PARSED_LINE = rf"""
WITH s AS (SELECT list(state_code) AS codes FROM state_ref),
a AS (SELECT ord, regexp_replace(regexp_replace(trim(coalesce(hq_address__value, '')), 'tel:\S+', '', 'g'), '\s*[|—]\s*', ', ', 'g') AS l FROM orgs),
b AS (SELECT ord, l, regexp_extract(l, '\b(\d{{5}})(?:-\d{{4}})?\b', 1) AS zip FROM a),
c AS (SELECT ord, zip, trim(regexp_replace(CASE WHEN zip <> '' THEN regexp_replace(l, '\b\d{{5}}(?:-\d{{4}})?\b.*$', '', 's') ELSE l END, '[,\s]+$', '')) AS l FROM b),
e AS (SELECT ord, zip, l, CASE WHEN list_contains(codes, regexp_extract(l, '\b([A-Z]{{2}})\s*$', 1)) THEN regexp_extract(l, '\b([A-Z]{{2}})\s*$', 1) ELSE '' END AS state FROM c, s),
f AS (SELECT ord, zip, state, [trim(p) for p in string_split(CASE WHEN state <> '' THEN regexp_replace(l, ',?\s*\b[A-Z]{{2}}\s*$', '') ELSE l END, ',') if trim(p) <> ''] AS p FROM e),
g AS (SELECT *, CASE WHEN regexp_matches(p[1], '\d') THEN 1 WHEN regexp_matches(p[2], '\d') THEN 2 ELSE 0 END AS k FROM f)
SELECT ord, CASE WHEN k > 0 THEN p[k] WHEN len(p) > 2 AND regexp_matches(p[len(p) - 1], '\d') THEN p[len(p) - 1] ELSE '' END AS street,
  CASE WHEN k > 0 THEN coalesce(p[k + 1], '') WHEN len(p) > 0 THEN p[len(p)] ELSE '' END AS city, state, zip FROM g
"""


@query(PARSED_LINE)
def address_lines(spark: SparkSession, d: str) -> DataFrame:
    """A free address line in its parts."""
    codes = [r[0] for r in table(spark, d, "state_ref").select("state_code").collect()]  # 52 rows, a list that does not grow
    return table(spark, d, "orgs").select("ord", ad.parse_address_line("hq_address__value", codes).alias("a")).select("ord", "a.*")


@query("""
WITH parts AS (SELECT ord, unnest([{'t': ['street_number'], 'v': address_street}, {'t': ['locality', 'political'], 'v': address_city}, {'t': ['administrative_area'], 'v': address_state}, {'t': ['postal_code'], 'v': address_zip}]) AS p FROM locations)
SELECT ord, max(CASE WHEN list_contains(p.t, 'locality') THEN p.v END) AS city, max(CASE WHEN list_contains(p.t, 'postal_code') THEN p.v END) AS zip FROM parts GROUP BY ord
""")
def typed_components(spark: SparkSession, d: str) -> DataFrame:
    """Values picked from a list of typed address components."""
    kinds = [("address_street", ["street_number"]), ("address_city", ["locality", "political"]), ("address_state", ["administrative_area"]), ("address_zip", ["postal_code"])]
    parts = F.array(*[F.struct(F.array(*[F.lit(k) for k in ks]).alias("t"), F.col(c).alias("v")) for c, ks in kinds])

    def pick(kind: str):
        return F.get(F.filter("p", lambda x: F.array_contains(x["t"], kind)), 0)["v"]

    return _loc(spark, d, *PLACE).select("ord", parts.alias("p")).select("ord", pick("locality").alias("city"), pick("postal_code").alias("zip"))


STATES = f"""
WITH r AS (SELECT state_code AS code, lower(state_name) AS name FROM state_ref UNION ALL SELECT c, NULL FROM (SELECT unnest(['VI', 'GU', 'AS', 'MP']) AS c)),
a AS (SELECT ord, {q.cl("address_state")} AS s, regexp_replace({q.lt("address_state")}, '[^a-z]', '', 'g') AS l, trim(replace({q.lt("address_state")}, '.', '')) AS n FROM locations),
b AS (SELECT a.*, x.code AS by_code, y.code AS by_name FROM a LEFT JOIN r x ON x.code = upper(CASE WHEN length(a.l) = 2 THEN a.l ELSE a.s END) LEFT JOIN r y ON y.name = a.n)
SELECT ord, CASE WHEN s = '' THEN '' ELSE coalesce(by_code, by_name, s) END AS state,
  CASE WHEN s = '' THEN 'blank' WHEN coalesce(by_code, by_name) IS NOT NULL THEN 'us' WHEN l IN ('us', 'usa') THEN 'us_unknown' ELSE 'intl' END AS kind FROM b
"""


def normal_states(rows: DataFrame, states: DataFrame, column: str = "address_state") -> DataFrame:
    """The rows with ``state`` and ``kind``: us with its code, us_unknown and intl as typed, blank as ''."""
    codes = states.select(F.col("state_code").alias("_code")).unionByName(states.sparkSession.createDataFrame([(t,) for t in ad.TERRITORIES], "_code string"))
    names = states.select(F.col("state_code").alias("_by_name"), F.lower("state_name").alias("_n"))
    letters = F.regexp_replace(lower_trim(column), "[^a-z]", "")
    marked = rows.withColumns({"_s": clean(column), "_l": letters, "_c": F.upper(F.when(F.length(letters) == 2, letters).otherwise(clean(column))), "_n": F.trim(F.replace(lower_trim(column), F.lit("."), F.lit("")))})
    met = marked.join(codes, F.col("_c") == F.col("_code"), "left").join(names, "_n", "left")
    found = F.coalesce("_code", "_by_name")
    state = F.when(F.col("_s") == "", "").otherwise(F.coalesce(found, "_s"))
    kind = F.when(F.col("_s") == "", "blank").when(found.isNotNull(), "us").when(F.col("_l").isin("us", "usa"), "us_unknown").otherwise("intl")
    return met.select(*rows.columns, state.alias("state"), kind.alias("kind"))


@query(STATES)
def state_codes(spark: SparkSession, d: str) -> DataFrame:
    """States as codes with their kind."""
    return normal_states(_loc(spark, d, "address_state"), table(spark, d, "state_ref")).select("ord", "state", "kind")


@query(f"SELECT ord, {q.norm_zip('address_zip')} AS zip, {q.norm_phone('phone')} AS number, {q.alnum('address_city')} AS city, {q.expand_city('address_city')} AS city_full FROM locations")
def place_keys(spark: SparkSession, d: str) -> DataFrame:
    """Postal code, phone and city keys."""
    return _loc(spark, d, *PLACE).select("ord", ad.norm_zip("address_zip").alias("zip"), ad.norm_phone("phone").alias("number"), ad.city_key("address_city").alias("city"), ad.expand_city("address_city").alias("city_full"))


_BAD = "CASE " + " ".join(f"WHEN address_state IN ({', '.join(q.quoted(s) for s in ss)}) THEN substr(address_zip, 1, 1) <> '{k}'" for k, ss in ad.ZIP_DIGIT.items()) + " ELSE false END"


@query(rf"SELECT ord, coalesce(regexp_matches(address_zip, '^\d{{5}}$') AND ({_BAD}), false) AS bad, regexp_matches(coalesce(address_street, ''), '\d') AS street, regexp_matches(lower(concat_ws(' ', coalesce(address_street, ''), coalesce(phone, ''), coalesce(location_name, ''))), '\b555[-).\s]?\d{{4}}\b|\b123 (research|study|main|example)\b|location a|location b|example') AS sample FROM locations")
def place_checks(spark: SparkSession, d: str) -> DataFrame:
    """streets with a number, made-up values, codes that are impossible in their state."""
    return _loc(spark, d, *PLACE).select("ord", ad.bad_zip("address_zip", "address_state").alias("bad"), ad.has_street("address_street").alias("street"), ad.looks_like_placeholder("address_street", "phone", "location_name").alias("sample"))


ZIP_FLAGS = f"""
WITH z AS (SELECT zip, list(DISTINCT state) AS states, list(DISTINCT {q.expand_city("city")}) AS towns, flatten(list([{q.expand_city("x")} for x in acceptable_cities])) AS more FROM zip_dim GROUP BY zip),
a AS (SELECT ord, {q.norm_zip("address_zip")} AS zip, upper({q.cl("address_state")}) AS state, {q.expand_city("address_city")} AS city FROM locations WHERE {q.norm_zip("address_zip")} <> '')
SELECT ord, CASE WHEN z.zip IS NULL THEN 'zip_invalid' WHEN a.state <> '' AND NOT list_contains(states, a.state) THEN 'state_mismatch' WHEN a.city <> '' AND NOT list_contains(towns, a.city) AND NOT list_contains(more, a.city) THEN 'city_mismatch' ELSE '' END AS flag
FROM a LEFT JOIN z ON a.zip = z.zip
"""


def zip_flagged(rows: DataFrame, zips: DataFrame) -> DataFrame:
    """rows with a postal code, and what contradicts it: '', zip_invalid, state_mismatch or city_mismatch."""
    known = zips.groupBy("zip").agg(F.collect_set("state").alias("_states"), F.collect_set(ad.expand_city("city")).alias("_towns"), F.flatten(F.collect_list(F.transform("acceptable_cities", ad.expand_city))).alias("_more"))
    asked = rows.withColumns({"zip": ad.norm_zip("address_zip"), "_state": F.upper(clean("address_state")), "_city": ad.expand_city("address_city")}).where("zip <> ''")
    met = asked.join(known, "zip", "left")
    state_bad = (F.col("_state") != "") & ~F.array_contains("_states", F.col("_state"))
    city_bad = (F.col("_city") != "") & ~F.array_contains("_towns", F.col("_city")) & ~F.array_contains("_more", F.col("_city"))
    flag = F.when(F.col("_states").isNull(), "zip_invalid").when(state_bad, "state_mismatch").when(city_bad, "city_mismatch").otherwise("")
    return met.select(*rows.columns, flag.alias("flag"))


@query(ZIP_FLAGS)
def zip_flags(spark: SparkSession, d: str) -> DataFrame:
    """what contradicts a place's postal code."""
    return zip_flagged(_loc(spark, d, "address_zip", "address_state", "address_city"), table(spark, d, "zip_dim")).select("ord", "flag")


@query(f"WITH f AS ({ZIP_FLAGS}), r AS (SELECT flag, ord, row_number() OVER (PARTITION BY flag ORDER BY ord) AS rank, count(*) OVER (PARTITION BY flag) AS n FROM f) SELECT flag, n, ord, rank FROM r WHERE rank <= 8")
def zip_report(spark: SparkSession, d: str) -> DataFrame:
    """The count of each flag with eight examples (a top-k report)."""
    from sitegrain.operators.ordered import first_k

    flags = zip_flags(spark, d)
    counts = flags.groupBy("flag").agg(F.count("*").alias("n"))
    return first_k(flags, ["flag"], [F.col("ord")], 8).join(counts, "flag").select("flag", "n", "ord", "rank")


NEAR = r"""
WITH p AS (SELECT domain, lower(trim(url)) AS url, min_by(html, ord) AS html FROM page_fetch WHERE html IS NOT NULL AND domain IS NOT NULL AND trim(url) <> '' GROUP BY domain, lower(trim(url))),
a AS (SELECT l.ord, coalesce(l.address_street, '') AS s, regexp_replace(lower(p.html), '[^a-z0-9]+', ' ', 'g') AS t FROM locations l JOIN p ON l.domain = p.domain AND lower(trim(l.source_url)) = p.url WHERE trim(coalesce(l.address_street, '')) <> ''),
b AS (SELECT ord, t, regexp_extract(s, '^\s*(\d+)', 1) AS n, regexp_extract_all(lower(s), '[a-z]{3,}') AS w FROM a),
c AS (SELECT ord, t, n, coalesce([x for x in w if x NOT IN (%s)][1], [x for x in w if x NOT IN ('suite', 'ste', 'unit', 'floor')][1]) AS word FROM b)
SELECT ord, CASE WHEN n = '' THEN true WHEN word IS NULL THEN list_contains(string_split(t, ' '), n) ELSE regexp_matches(t, '\b' || n || '\b[^0-9]{0,50}\b' || word || '\b') END AS on_page FROM c
""" % ", ".join(q.quoted(w) for w in ad.INDISTINCT)


@query(NEAR)
def streets_on_pages(spark: SparkSession, d: str) -> DataFrame:
    """F8: whether a place's street stands on the page it was read from."""
    pages = table(spark, d, "page_fetch").where("html is not null and domain is not null and trim(url) <> ''")
    first = pages.groupBy("domain", F.lower(F.trim("url")).alias("url")).agg(F.min_by("html", "ord").alias("html"))
    rows = _loc(spark, d, "domain", "address_street", "source_url").where(~is_blank("address_street")).withColumn("url", F.lower(F.trim("source_url")))
    return rows.join(first, ["domain", "url"]).select("ord", ad.street_on_page("address_street", "html").alias("on_page"))


_TARGET = {"no_zip": "z = '' AND s <> '' AND c <> '' AND st <> ''", "no_street": "s = '' AND c <> '' AND st <> ''", "incomplete": "(s = '' OR z = '') AND u <> ''", "name_only": "n <> '' AND s = '' AND c = '' AND z = ''"}


@query(f"SELECT ord, {', '.join(f'({v}) AS {k}' for k, v in _TARGET.items())} FROM (SELECT ord, {q.cl('address_zip')} AS z, {q.cl('address_street')} AS s, {q.cl('address_city')} AS c, {q.cl('address_state')} AS st, {q.cl('source_url')} AS u, {q.cl('location_name')} AS n FROM locations) x WHERE {' OR '.join(f'({v})' for v in _TARGET.values())}")
def incomplete_places(spark: SparkSession, d: str) -> DataFrame:
    """places that lack a part which the others could give."""
    x = {"z": "address_zip", "s": "address_street", "c": "address_city", "st": "address_state", "u": "source_url", "n": "location_name"}
    rows = _loc(spark, d, *x.values()).select("ord", *[clean(c).alias(k) for k, c in x.items()])
    return rows.select("ord", *[F.expr(v).alias(k) for k, v in _TARGET.items()]).where(" or ".join(_TARGET))


FIRST = "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS k_, min(ord) OVER (PARTITION BY {key}) AS first_ord, count(*) OVER (PARTITION BY {key}) AS n_rows FROM locations) x WHERE k_ = 1"
FIVE = ["address_zip", "address_street", "phone", "address_city", "location_name"]


@query(FIRST.format(cols="ord, first_ord, n_rows", key=f"{q.lt('domain')}, {q.norm_street('address_street')}, {q.alnum('address_city')}, upper({q.cl('address_state')})", order=f"{q.filled(*FIVE)} DESC, ord"))
def location_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """Each place of a domain once, by its most complete row."""
    return dd.most_complete(_loc(spark, d, *PLACE), dd.street_key(), FIVE).select("ord", "first_ord", "n_rows")


@query(FIRST.format(cols="ord, first_ord, n_rows", key=f"{q.lt('domain')}, {q.alnum('address_state')}, {q.alnum('address_city')}, {q.sig_number('address_street')}, {q.sig_word('address_street')}", order=f"{q.filled(*FIVE[:4])} DESC, ord"))
def location_dedupe_signature(spark: SparkSession, d: str) -> DataFrame:
    """D3: the same by house number and street word."""
    return dd.most_complete(_loc(spark, d, *PLACE), dd.signature_key(), FIVE[:4]).select("ord", "first_ord", "n_rows")


TWO_STAGE = f"""
WITH a AS (SELECT ord, {q.lt("domain")} AS d, {q.cl("address_zip")} AS z, {q.alnum("address_city")} AS c, {q.cl("address_street")} = '' AS bare, {q.sig_number("address_street")} AS n, {q.sig_word("address_street")} AS w FROM locations),
b AS (SELECT * FROM a WHERE NOT bare OR ((z <> '' OR c <> '')
  AND NOT (z <> '' AND EXISTS (SELECT 1 FROM a x WHERE NOT x.bare AND x.d = a.d AND x.z = a.z)) AND NOT (c <> '' AND EXISTS (SELECT 1 FROM a x WHERE NOT x.bare AND x.d = a.d AND x.c = a.c))))
SELECT min(ord) AS ord FROM b GROUP BY d, bare, CASE WHEN bare THEN z || '|' || c WHEN z <> '' THEN z ELSE c END, n, w
"""


@query(TWO_STAGE)
def location_dedupe_two_stage(spark: SparkSession, d: str) -> DataFrame:
    """Places without a street go where one with a street covers them, then the first of each remains."""
    return dd.dedupe_places(_loc(spark, d, *PLACE)).select("ord")


@query(f"SELECT min(ord) AS ord FROM locations GROUP BY {q.lt('address_street')}, {q.lt('address_city')}, {q.lt('address_zip')}, CASE WHEN {q.lt('address_street')} || {q.lt('address_city')} || {q.lt('address_zip')} = '' THEN ord END")
def location_dedupe_unless_blank(spark: SparkSession, d: str) -> DataFrame:
    """Equal addresses once, rows without any address all."""
    return dd.dedupe_unless_blank(_loc(spark, d, *PLACE), ["address_street", "address_city", "address_zip"]).select("ord")




@query("""
WITH c AS (SELECT ord AS c_ord, lower(trim(source_url)) AS url, address_street AS c_street, regexp_replace(lower(coalesce(address_city, '')), '[^a-z0-9]', '', 'g') AS c_city, trim(coalesce(address_street, '')) <> '' AS c_has FROM locations WHERE trim(coalesce(address_zip, '')) <> ''),
r AS (SELECT ord, lower(trim(source_url)) AS url, regexp_replace(lower(coalesce(address_city, '')), '[^a-z0-9]', '', 'g') AS city FROM locations WHERE trim(coalesce(address_zip, '')) = '' AND trim(coalesce(source_url, '')) <> ''),
m AS (SELECT r.ord, c.c_ord, row_number() OVER (PARTITION BY r.ord ORDER BY (c.c_city = r.city AND r.city <> '') DESC, c.c_has DESC, c.c_ord) AS k FROM r JOIN c USING (url))
SELECT r.ord, m.c_ord FROM r LEFT JOIN m ON r.ord = m.ord AND m.k = 1
""")
def candidate_by_city(spark: SparkSession, d: str) -> DataFrame:
    """For a place without a postal code the best complete row of the same page: the same city, then a street, then the first."""
    rows, found = _page_rows(spark, d)
    same = (F.col("c_city") == F.col("city")) & (F.col("city") != "")
    return best_match(rows, found, "url", [same, F.col("c_has")], tie="c_ord").select("ord", "c_ord")


def _page_rows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    loc = _loc(spark, d, *PLACE, "source_url").withColumns({"url": F.lower(F.trim("source_url")), "city": ad.city_key("address_city"), "name": ad.city_key("location_name")})
    rows = loc.where(is_blank("address_zip") & ~is_blank("source_url")).select("ord", "url", "city", "name")
    found = loc.where(~is_blank("address_zip")).select("url", F.col("ord").alias("c_ord"), F.col("city").alias("c_city"), F.col("name").alias("c_name"), (~is_blank("address_street")).alias("c_has"))
    return rows, found


@query("""
WITH k AS (SELECT ord, lower(trim(source_url)) AS url, regexp_replace(lower(coalesce(address_city, '')), '[^a-z0-9]', '', 'g') AS city, regexp_replace(lower(coalesce(location_name, '')), '[^a-z0-9]', '', 'g') AS name, trim(coalesce(address_zip, '')) <> '' AS done FROM locations),
r AS (SELECT * FROM k WHERE NOT done AND coalesce(url, '') <> ''), c AS (SELECT * FROM k WHERE done),
m AS (SELECT r.ord, c.ord AS c_ord, row_number() OVER (PARTITION BY r.ord ORDER BY (r.city <> '' AND c.city = r.city) DESC, c.ord) AS k
  FROM r JOIN c USING (url) WHERE CASE WHEN r.city <> '' THEN c.city = r.city ELSE r.name <> '' AND c.name <> '' AND (contains(c.name, r.name) OR contains(r.name, c.name)) END)
SELECT r.ord, m.c_ord FROM r LEFT JOIN m ON r.ord = m.ord AND m.k = 1
""")
def candidate_strict(spark: SparkSession, d: str) -> DataFrame:
    """The same, but a city must agree, or the names where the place has no city."""
    rows, found = _page_rows(spark, d)
    same = (F.col("city") != "") & (F.col("c_city") == F.col("city"))
    named = (F.col("name") != "") & (F.col("c_name") != "") & (F.contains("c_name", "name") | F.contains("name", "c_name"))
    return best_match(rows, found, "url", [same], F.when(F.col("city") != "", same).otherwise(named)).select("ord", "c_ord")


@query("""
WITH n AS (SELECT ord, domain, regexp_replace(lower(coalesce(canonical_org_name__value, '')), '[^a-z0-9]', '', 'g') AS name FROM orgs),
c AS (SELECT min(ord) AS c_ord, domain, regexp_replace(lower(coalesce(location_name, '')), '[^a-z0-9]', '', 'g') AS c_name FROM locations GROUP BY ALL),
m AS (SELECT n.ord, c.c_ord, len(list_intersect(list_distinct(string_split(name, '')), list_distinct(string_split(c_name, '')))) AS score FROM n JOIN c USING (domain) WHERE name <> '' AND c_name <> '' AND (contains(name, c_name) OR contains(c_name, name))),
k AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, c_ord) AS k FROM m WHERE score > 0)
SELECT n.ord, k.c_ord, k.score FROM n LEFT JOIN k ON n.ord = k.ord AND k.k = 1
""")
def name_containment(spark: SparkSession, d: str) -> DataFrame:
    """Organisations and the names of their domain that contain them or are contained, the most letters in common."""
    orgs = table(spark, d, "orgs").select("ord", "domain", ad.city_key("canonical_org_name__value").alias("name"))
    found = _loc(spark, d, "domain", "location_name").groupBy("domain", ad.city_key("location_name").alias("c_name")).agg(F.min("ord").alias("c_ord"))
    found = found.where("c_name <> ''")
    score = shared_letters(F.col("name"), F.col("c_name"))
    either = (F.col("name") != "") & (F.contains("name", "c_name") | F.contains("c_name", "name"))
    out = best_match(orgs, found, "domain", [score], either)
    return out.select("ord", "c_ord", F.when(F.col("c_ord").isNotNull(), score.cast("long")).alias("score"))


@query(f"""
WITH u AS (SELECT {q.lt('address_street')} AS s, {q.lt('address_city')} AS c, min_by(address_zip, ord) AS answer FROM locations WHERE {q.cl('address_zip')} <> '' GROUP BY 1, 2)
SELECT l.ord, coalesce(u.answer, 'No_Match') AS answer FROM locations l LEFT JOIN u ON {q.lt('l.address_street')} = u.s AND {q.lt('l.address_city')} = u.c WHERE {q.cl('l.address_street')} <> ''
""")
def address_answers(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct address is answered once (the first value of its key) and the answer goes back to every row."""
    keyed = _loc(spark, d, *PLACE).withColumns({"s": lower_trim("address_street"), "c": lower_trim("address_city")})
    answers = keyed.where(~is_blank("address_zip")).groupBy("s", "c").agg(F.min_by("address_zip", "ord").alias("answer"))
    rows = keyed.where("s <> ''")
    return rows.join(answers, ["s", "c"], "left").select("ord", F.coalesce("answer", F.lit("No_Match")).alias("answer"))


@query(f"""
WITH t AS (SELECT city_, state_, min(zip) AS zip FROM (SELECT zip, lower(city) AS city_, state AS state_ FROM zip_dim) x GROUP BY 1, 2)
SELECT l.ord, CASE WHEN {q.cl('address_zip')} = '' THEN coalesce(t.zip, '') ELSE l.address_zip END AS address_zip, ({q.cl('address_zip')} = '' AND t.zip IS NOT NULL) AS filled
FROM locations l LEFT JOIN t ON t.city_ = {q.expand_city('l.address_city')} AND t.state_ = l.address_state
""")
def zip_filled(spark: SparkSession, d: str) -> DataFrame:
    """Blank postal codes filled from the reference by city and state."""
    known = table(spark, d, "zip_dim").groupBy(F.lower("city").alias("_c"), F.col("state").alias("address_state")).agg(F.min("zip").alias("_zip"))
    rows = _loc(spark, d, *PLACE).withColumn("_c", ad.expand_city("address_city"))
    met = rows.join(known, ["_c", "address_state"], "left")
    return met.select("ord", ad.fill_blank("address_zip", "_zip").alias("address_zip"), (is_blank("address_zip") & F.col("_zip").isNotNull()).alias("filled"))


@query(f"WITH s AS ({STATES}) SELECT l.ord, s.state AS address_state, {q.norm_zip('address_zip')} AS address_zip FROM locations l JOIN s USING (ord) WHERE s.kind <> 'intl'")
def normalised_places(spark: SparkSession, d: str) -> DataFrame:
    """State codes and five-digit postal codes; places outside of the country go."""
    rows = normal_states(_loc(spark, d, "address_state", "address_zip"), table(spark, d, "state_ref")).where("kind <> 'intl'")
    return rows.select("ord", F.col("state").alias("address_state"), ad.norm_zip("address_zip").alias("address_zip"))
