"""Queries of joins, shapes, aggregates, windows, sets and scores over the organisation and crawl tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.scoring import COMPARATORS
from sitegrain.functions.text import alnum_key, clean, filled, is_blank, lower_trim, squeeze
from sitegrain.operators import aggregate as ag
from sitegrain.operators import joins as jo
from sitegrain.operators import ordered as od
from sitegrain.operators import reshape as rs
from sitegrain.operators.dedupe import completeness, distinct_first
from sitegrain.plans import sqltext as q
from sitegrain.plans.registry import query
from sitegrain.sources import files, sinks
from sitegrain.sources.tables import scratch_path as _path
from sitegrain.sources.tables import table

FIELDS = rs.FIELDS


def _t(spark: SparkSession, d: str, name: str, *columns: str) -> DataFrame:
    rows = table(spark, d, name)
    return rows.select(*columns) if columns else rows


# Sources and sinks: written to the shared folder and read back.


@query("SELECT ord::VARCHAR AS ord, coalesce(domain, '') AS domain, coalesce(location_name, '') AS location_name, coalesce(snippet, '') AS snippet, coalesce(phone, '') AS phone FROM locations")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The table as CSV and read again; missing is '' and spaces stay."""
    path = _path(spark, "csv")
    columns = ["ord", "domain", "location_name", "snippet", "phone"]
    sinks.write_csv(_t(spark, d, "locations"), path, columns)
    return files.read_csv(spark, path)


@query("SELECT coalesce(name, '') AS name, coalesce(n, '') AS n FROM (SELECT source AS name, max_repeats::VARCHAR AS n FROM mix_targets) x")
def csv_without_header(spark: SparkSession, d: str) -> DataFrame:
    """A CSV file without a header."""
    path = _path(spark, "bare")
    _t(spark, d, "mix_targets", "source", "max_repeats").write.csv(path, header=False, escape='"')
    return files.read_csv(spark, path, header=False, columns=["name", "n"])


@query("SELECT domain, status, pages_used, llm_in_tok, detail FROM classified_rows UNION ALL SELECT domain, status, pages_used, llm_in_tok, detail FROM classified_rows WHERE status = 'ok'")
def json_lines_appended(spark: SparkSession, d: str) -> DataFrame:
    """S3, K4: JSON lines, appended to and read under a fixed schema."""
    rows = _t(spark, d, "classified_rows", "domain", "status", "pages_used", "llm_in_tok", "detail")
    path = _path(spark, "lines")
    sinks.append_json_lines(rows, path)
    sinks.append_json_lines(rows.where("status = 'ok'"), path)
    return files.read_json_lines(spark, path, rows.schema)


@query("SELECT DISTINCT domain FROM orgs WHERE domain IS NOT NULL AND trim(domain) <> ''")
def domain_list(spark: SparkSession, d: str) -> DataFrame:
    """A list of domains with a header and comments."""
    path = _path(spark, "list")
    domains = _t(spark, d, "orgs", "domain").where(clean("domain") != "").distinct()
    notes = spark.createDataFrame([("domain",), ("# a comment",), ("",)], "domain string")
    notes.unionByName(domains).write.text(path)
    return files.domain_column(files.read_list(spark, path))


@query(r"WITH a AS (SELECT regexp_replace(regexp_replace(lower(trim(url)), 'https?://|www\.', '', 'g'), '^/+|/+$', '', 'g') AS domain, ord FROM page_fetch WHERE url IS NOT NULL) SELECT domain, min(ord) AS ord FROM a WHERE contains(domain, '.') AND NOT contains(domain, ' ') GROUP BY domain")
def input_domains(spark: SparkSession, d: str) -> DataFrame:
    """Normal, valid and distinct inputs at their first places."""
    return files.clean_domains(_t(spark, d, "page_fetch", F.col("url").alias("domain"), "ord").where("domain is not null"))


@query("SELECT domain FROM (SELECT DISTINCT domain FROM orgs WHERE domain IS NOT NULL) o WHERE domain NOT IN (SELECT domain FROM classified_rows WHERE domain IS NOT NULL)")
def unprocessed(spark: SparkSession, d: str) -> DataFrame:
    """The domains that an output on disk doesn't hold yet."""
    path = _path(spark, "done")
    before = files.processed_keys(spark, path)
    sinks.write_csv(_t(spark, d, "classified_rows", "domain").where("domain is not null"), path)
    rows = _t(spark, d, "orgs", "domain").where("domain is not null").distinct()
    return jo.todo(jo.todo(rows, before, "domain"), files.processed_keys(spark, path), "domain")


@query("SELECT ord, domain FROM (SELECT ord, domain FROM orgs WHERE fetch_status IS DISTINCT FROM 'parked' UNION ALL SELECT ord + 1000000, domain FROM orgs WHERE fetch_status = 'parked') x")
def master_replaced(spark: SparkSession, d: str) -> DataFrame:
    """K3: a master rewritten from itself, with a backup."""
    path, backup = _path(spark, "master"), _path(spark, "backup")
    _t(spark, d, "orgs", "ord", "domain", "fetch_status").write.parquet(path)
    old = spark.read.parquet(path)
    sinks.replace_master(old.withColumn("ord", F.when(F.col("fetch_status") == "parked", F.col("ord") + 1_000_000).otherwise(F.col("ord"))), path, backup)
    return spark.read.parquet(path).select("ord", "domain")


_COLS = "chr((65 + CASE WHEN n < 26 THEN n ELSE n // 26 - 1 END)::INT) || CASE WHEN n < 26 THEN '' ELSE chr((65 + n % 26)::INT) END"


@query(f"SELECT ord, row_no, (row_no - 1) // 1000 AS batch, 'A' || ((row_no - 1) // 1000 * 1000 + 2) || ':C' || ((row_no - 1) // 1000 * 1000 + 1001) AS cells, (SELECT {_COLS} FROM (SELECT (ord % 60) AS n) x) AS letters FROM (SELECT ord, row_number() OVER (ORDER BY ord) AS row_no FROM orgs) y")
def sheet_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Sheet rows, batches of 1000, their ranges and column letters."""
    rows = sinks.sheet_batches(_t(spark, d, "orgs", "ord", "domain", "fetch_status"))
    return rows.select("ord", "row_no", "batch", "cells", sinks.column_letter(F.col("ord") % 60 + 1).alias("letters"))


@query("SELECT url, max(ord) AS ord FROM page_fetch WHERE url IS NOT NULL AND html IS NOT NULL GROUP BY url")
def cache_upserted(spark: SparkSession, d: str) -> DataFrame:
    """A page cache in which later fetches replace earlier ones."""
    rows = _t(spark, d, "page_fetch", "url", "ord", "html").where("url is not null and html is not null").drop("html")
    first = rows.groupBy("url").agg(F.min("ord").alias("ord"))
    last = jo.last_per_key(rows, ["url"]).select("url", "ord")
    return sinks.upsert(first, last, "url")


# Joins.


@query("WITH done AS (SELECT domain FROM classified_rows) SELECT ord, domain FROM orgs WHERE domain NOT IN (SELECT domain FROM done WHERE domain IS NOT NULL) ORDER BY ord LIMIT 50")
def resume_todo(spark: SparkSession, d: str) -> DataFrame:
    """The next 50 organisations that are not classified (the limit is the feature)."""
    return jo.todo(_t(spark, d, "orgs", "ord", "domain"), _t(spark, d, "classified_rows", "domain").where("domain is not null"), "domain", limit=50).where("domain is not null")


_LAST = "(SELECT domain, max(ord) AS ord, arg_max(coalesce(status, ''), ord) AS v FROM classified_rows WHERE domain IS NOT NULL GROUP BY domain)"


@query(f"SELECT o.domain, coalesce(n.v, o.fetch_status) AS v, 0 AS part, o.ord AS place FROM orgs o LEFT JOIN {_LAST} n USING (domain) UNION ALL SELECT domain, v, 1, ord FROM {_LAST} n WHERE domain NOT IN (SELECT domain FROM orgs WHERE domain IS NOT NULL)")
def replaced_every(spark: SparkSession, d: str) -> DataFrame:
    """Every row of a key takes the last new row; unknown keys follow."""
    master = _t(spark, d, "orgs", "ord", "domain", F.col("fetch_status").alias("v"))
    new = _t(spark, d, "classified_rows", "ord", "domain", F.coalesce("status", F.lit("")).alias("v"))
    return jo.replace_every(master, new, "domain")


@query(f"SELECT o.ord, o.domain, CASE WHEN n.domain IS NOT NULL AND o.ord = min(o.ord) OVER (PARTITION BY o.domain) THEN n.v ELSE o.fetch_status END AS v, o.error FROM orgs o LEFT JOIN {_LAST} n USING (domain)")
def replaced_first(spark: SparkSession, d: str) -> DataFrame:
    """Only the first row of a key takes the new values; columns that the new rows lack stay."""
    new = _t(spark, d, "classified_rows", "ord", "domain", F.coalesce("status", F.lit("")).alias("v"))
    return jo.replace_first(_t(spark, d, "orgs", "ord", "domain", F.col("fetch_status").alias("v"), "error"), new, "domain")


@query("SELECT domain, 'old' AS origin, 0 AS part FROM locations WHERE lower(trim(coalesce(domain, ''))) NOT IN (SELECT lower(trim(coalesce(domain, ''))) FROM orgs) UNION ALL SELECT domain, 'new', 1 FROM orgs")
def replaced_partitions(spark: SparkSession, d: str) -> DataFrame:
    """All old rows of covered keys go, the new rows follow."""
    old = _t(spark, d, "locations", "domain").withColumn("origin", F.lit("old"))
    return jo.replace_partitions(old, _t(spark, d, "orgs", "domain").withColumn("origin", F.lit("new")), lower_trim("domain"))


@query("SELECT l.ord, coalesce(s.state_name, 'unknown') AS state_name FROM locations l LEFT JOIN state_ref s ON s.state_code = l.address_state")
def looked_up(spark: SparkSession, d: str) -> DataFrame:
    """A lookup with a default."""
    names = _t(spark, d, "state_ref", F.col("state_code").alias("address_state"), "state_name")
    return jo.lookup(_t(spark, d, "locations", "ord", "address_state"), names, "address_state", {"state_name": "unknown"}).select("ord", "state_name")


@query("SELECT o.ord, 'req-' || o.ord AS request_id, coalesce(r.status, 'batch_error') AS status FROM orgs o LEFT JOIN (SELECT ord, coalesce(status, '') AS status FROM classified_rows WHERE status <> 'failed') r ON r.ord = o.ord")
def requests_joined(spark: SparkSession, d: str) -> DataFrame:
    """Results joined back by the request's id; a missing one is an error row; the order is kept as data."""
    asked = _t(spark, d, "orgs", "ord").withColumn("request_id", F.concat(F.lit("req-"), "ord"))
    got = _t(spark, d, "classified_rows", "ord", "status").where("status <> 'failed'").select(F.concat(F.lit("req-"), "ord").alias("request_id"), F.coalesce("status", F.lit("")).alias("status"))
    return jo.lookup(asked, got, "request_id", {"status": "batch_error"})


@query("""WITH p AS (SELECT domain, bool_or(coalesce(html, '') <> '') AS page FROM page_fetch WHERE domain IS NOT NULL GROUP BY domain), l AS (SELECT DISTINCT domain FROM locations)
SELECT o.ord, CASE WHEN p.page THEN 'page' WHEN l.domain IS NOT NULL THEN 'place' ELSE 'skip' END AS origin FROM orgs o LEFT JOIN p ON p.domain = o.domain LEFT JOIN l ON l.domain = o.domain""")
def source_chain(spark: SparkSession, d: str) -> DataFrame:
    """The first source that has something for a domain."""
    pages = _t(spark, d, "page_fetch").where("domain is not null").groupBy("domain").agg(F.max(F.coalesce("html", F.lit("")) != "").alias("page"))
    places = _t(spark, d, "locations", "domain").where("domain is not null").distinct().withColumn("place", F.lit(True))
    rows = _t(spark, d, "orgs", "ord", "domain").join(pages, "domain", "left").join(places, "domain", "left")
    return rows.select("ord", F.coalesce(jo.first_of((F.col("page"), F.lit("page")), (F.col("place"), F.lit("place"))), F.lit("skip")).alias("origin"))


# Shapes.


@query("SELECT ord, " + ", ".join(f"coalesce({f}__{p}, '') AS {f}__{p}" for f in FIELDS for p in rs.PARTS) + " FROM orgs")
def widened(spark: SparkSession, d: str) -> DataFrame:
    """Nested evidence as wide columns, nulls as ''."""
    wide = ["ord", *[f"{f}__{p}" for f in FIELDS for p in rs.PARTS]]
    return rs.widen(rs.nest(_t(spark, d, "orgs", *wide)))


@query("SELECT o.ord, l.location_name AS name, 'crawl' AS source, (row_number() OVER (PARTITION BY o.ord ORDER BY l.ord) - 1)::INT AS pos FROM (SELECT domain, min(ord) AS ord FROM orgs WHERE domain IS NOT NULL GROUP BY domain) o JOIN locations l USING (domain)")
def child_rows(spark: SparkSession, d: str) -> DataFrame:
    """Arrays of children as rows with the parent's key."""
    kids = _t(spark, d, "locations", "domain", "ord", "location_name").groupBy("domain").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col("location_name").alias("name")))), lambda x: F.struct(x["name"].alias("name"))).alias("kids"))
    parents = _t(spark, d, "orgs", "domain", "ord").where("domain is not null").groupBy("domain").agg(F.min("ord").alias("ord")).join(kids, "domain")
    return rs.explode_children(parents, ["ord"], "kids", {"source": "crawl"})


_UNPIVOT = " UNION ALL ".join(f"SELECT ord, '{f}' AS field, {f}__value AS actual, {f}__confidence AS confidence, substr(coalesce({f}__snippet, ''), 1, 120) AS snippet FROM orgs" for f in FIELDS)


@query(_UNPIVOT)
def unpivoted(spark: SparkSession, d: str) -> DataFrame:
    """A row for each field of each organisation."""
    long = rs.unpivot(_t(spark, d, "orgs"), ["ord"], FIELDS, {"actual": "{}__value", "confidence": "{}__confidence", "snippet": "{}__snippet"})
    return long.withColumn("snippet", F.substring(F.coalesce("snippet", F.lit("")), 1, 120))


@query("SELECT ord, domain, 'skipped' AS status, CASE WHEN fetch_status = 'parked' THEN 'parked' ELSE '' END AS detail, '0' AS pages_used FROM orgs WHERE fetch_status IN ('parked', 'blocked') UNION ALL SELECT ord, domain, status, coalesce(detail, ''), coalesce(pages_used, '0') FROM classified_rows")
def templated_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a constant template beside finished rows."""
    skipped = _t(spark, d, "orgs", "ord", "domain", "fetch_status").where(F.col("fetch_status").isin("parked", "blocked"))
    skipped = skipped.select("ord", "domain", F.lit("skipped").alias("status"), F.when(F.col("fetch_status") == "parked", "parked").otherwise("").alias("detail"))
    done = _t(spark, d, "classified_rows", "ord", "domain", "status", "detail", "pages_used")
    return skipped.unionByName(done, allowMissingColumns=True).na.fill({"detail": "", "pages_used": "0"})


@query("WITH n AS (SELECT domain, count(*)::VARCHAR AS n FROM locations GROUP BY domain) SELECT o.ord, coalesce(n.n, '') AS location_count FROM orgs o LEFT JOIN n USING (domain)")
def recounted(spark: SparkSession, d: str) -> DataFrame:
    """P5, X11: a column replaced by a recount, '' for unmatched rows."""
    counts = _t(spark, d, "locations", "domain").where("domain is not null").groupBy("domain").agg(F.count("*").cast("string").alias("location_count"))
    rows = _t(spark, d, "orgs", "ord", "domain").withColumn("location_count", F.lit("stale"))
    return rs.with_default(rows, counts, "domain", "location_count", "").select("ord", "location_count")


@query(f"SELECT ord, CASE WHEN coalesce(nullif(address_street, ''), nullif(address_city, ''), nullif(address_zip, '')) IS NOT NULL THEN 'passed' ELSE 'needs_review' END AS status, {q.filled('address_zip', 'address_street', 'phone', 'address_city', 'location_name')} AS filled FROM locations")
def row_status(spark: SparkSession, d: str) -> DataFrame:
    """A status by presence, and the completeness score."""
    present = F.coalesce(*[F.expr(f"nullif({c}, '')") for c in ("address_street", "address_city", "address_zip")]).isNotNull()
    return _t(spark, d, "locations").select("ord", F.when(present, "passed").otherwise("needs_review").alias("status"), completeness("address_zip", "address_street", "phone", "address_city", "location_name").alias("filled"))


@query("SELECT ord, " + " + ".join(f"(CASE WHEN coalesce({f}__confidence, 'not_found') <> 'not_found' THEN 1 ELSE 0 END)" for f in FIELDS) + " AS found FROM orgs")
def found_fields(spark: SparkSession, d: str) -> DataFrame:
    """How many fields of a row were found."""
    rows = _t(spark, d, "orgs")
    return rows.select("ord", rs.filled_count(rows, [f"{f}__confidence" for f in FIELDS]).alias("found"))


@query("WITH c AS (SELECT domain, ord AS c_ord, row_number() OVER (PARTITION BY domain ORDER BY ord) AS copy_no FROM page_fetch WHERE coalesce(html, '') <> '') SELECT o.ord, coalesce(c.copy_no, 0) AS copy_no, c.c_ord FROM orgs o LEFT JOIN c USING (domain)")
def expanded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Each row once for each match, or as it is."""
    rows = _t(spark, d, "orgs", "ord", "domain")
    found = jo.numbered(_t(spark, d, "page_fetch", "domain", "ord", "html").where(F.coalesce("html", F.lit("")) != ""), "ord", "copy_no", ["domain"])
    copies = rows.join(found.select("domain", F.col("ord").alias("c_ord"), "copy_no"), "domain").select("ord", "copy_no", "c_ord")
    return rs.expand_in_place(rows, copies).select("ord", "copy_no", "c_ord")


@query(r"SELECT domain, string_agg(substr(coalesce(snippet, ''), 1, 80), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY ord) AS text FROM locations WHERE domain IS NOT NULL GROUP BY domain")
def assembled(spark: SparkSession, d: str) -> DataFrame:
    """The texts of a group in order, each cut, with separators."""
    return rs.assembled_text(_t(spark, d, "locations").where("domain is not null"), ["domain"], "snippet", "ord", 80)


@query("SELECT ord, array_to_string(list_sort(list_distinct([trim(x) for x in string_split(coalesce(specialties, ''), ';') if trim(x) <> ''])), '; ') AS tags FROM classified_rows")
def tag_lists(spark: SparkSession, d: str) -> DataFrame:
    """Tags split, distinct, sorted and joined."""
    tags = F.filter(F.transform(F.split(F.coalesce("specialties", F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    return _t(spark, d, "classified_rows").select("ord", F.array_join(F.array_sort(F.array_distinct(tags)), "; ").alias("tags"))


# Filters on membership and evidence.


@query("SELECT o.ord FROM orgs o JOIN (SELECT domain, arg_max(fetch_status, ord) AS s, arg_max(coalesce(canonical_org_name__value, ''), ord) AS n, max(ord) AS ord FROM orgs WHERE domain IS NOT NULL GROUP BY domain) x USING (ord) WHERE x.s IN ('ok', 'success') AND trim(x.n) = ''")
def reextract_targets(spark: SparkSession, d: str) -> DataFrame:
    """The last row of a domain, where it succeeded without a name."""
    last = jo.last_per_key(_t(spark, d, "orgs", "ord", "domain", "fetch_status", "canonical_org_name__value").where("domain is not null"), ["domain"])
    return last.where(F.col("fetch_status").isin("ok", "success") & is_blank("canonical_org_name__value")).select("ord")


@query("SELECT ord FROM orgs WHERE lower(trim(coalesce(org_subcategory__value, ''))) IN ('research_site_network', 'specialty_practice_with_research', 'hospital') AND fetch_status IN ('ok', 'blocked')")
def gated_rows(spark: SparkSession, d: str) -> DataFrame:
    """rows of given labels and states."""
    label = lower_trim("org_subcategory__value").isin("research_site_network", "specialty_practice_with_research", "hospital")
    return _t(spark, d, "orgs").where(label & F.col("fetch_status").isin("ok", "blocked")).select("ord")


@query("WITH s AS (SELECT url, max(status_code) AS code FROM page_fetch WHERE url IS NOT NULL GROUP BY url) SELECT o.ord, CASE WHEN s.code IN (404, 410, 451) OR s.code >= 500 THEN '' ELSE coalesce(o.research_url__value, '') END AS research_url FROM orgs o LEFT JOIN s ON s.url = o.research_url__value")
def dead_links_blanked(spark: SparkSession, d: str) -> DataFrame:
    """a URL is blanked where its page is gone."""
    codes = _t(spark, d, "page_fetch").where("url is not null").groupBy(F.col("url").alias("research_url__value")).agg(F.max("status_code").alias("code"))
    rows = _t(spark, d, "orgs", "ord", "research_url__value").join(codes, "research_url__value", "left")
    gone = F.col("code").isin(404, 410, 451) | (F.col("code") >= 500)
    return rows.select("ord", F.when(gone, "").otherwise(F.coalesce("research_url__value", F.lit(""))).alias("research_url"))


@query("SELECT c.ord, x.tag FROM (SELECT ord, unnest([trim(t) for t in string_split(coalesce(specialties, ''), ';')]) AS tag FROM classified_rows) x JOIN classified_rows c USING (ord) WHERE x.tag IN (SELECT canonical_name FROM specialty_ref)")
def supplied_only(spark: SparkSession, d: str) -> DataFrame:
    """Only values of a supplied set are taken."""
    tags = _t(spark, d, "classified_rows").select("ord", F.explode(F.transform(F.split(F.coalesce("specialties", F.lit("")), ";"), lambda x: F.trim(x))).alias("tag"))
    return tags.join(_t(spark, d, "specialty_ref", F.col("canonical_name").alias("tag")), "tag", "left_semi").select("ord", "tag")


@query("SELECT l.ord, bool_or(contains(coalesce(p.html, ''), l.snippet)) AS verbatim FROM locations l JOIN page_fetch p ON p.domain = l.domain AND p.url = l.source_url WHERE trim(coalesce(l.snippet, '')) <> '' GROUP BY l.ord")
def verbatim_snippets(spark: SparkSession, d: str) -> DataFrame:
    """whether a snippet stands on its page."""
    pages = _t(spark, d, "page_fetch", "domain", F.col("url").alias("source_url"), "html")
    rows = _t(spark, d, "locations", "ord", "domain", "source_url", "snippet").where(~is_blank("snippet"))
    return rows.join(pages, ["domain", "source_url"]).groupBy("ord").agg(F.max(F.contains(F.coalesce("html", F.lit("")), "snippet")).alias("verbatim"))


# Distinct, aggregates.


@query("SELECT domain, min(ord) AS ord FROM locations WHERE domain IS NOT NULL GROUP BY domain")
def first_seen(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each domain."""
    return distinct_first(_t(spark, d, "locations", "ord", "domain").where("domain is not null"), [F.col("domain")])


@query("SELECT domain, min(ord) AS first_ord, max(ord) AS ord, arg_max(coalesce(status, ''), ord) AS status FROM classified_rows WHERE domain IS NOT NULL GROUP BY domain")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    """The last row of each domain at its first place."""
    rows = _t(spark, d, "classified_rows", "ord", "domain", F.coalesce("status", F.lit("")).alias("status")).where("domain is not null")
    return jo.last_per_key(rows, ["domain"])


@query("SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY source")
def source_shares(spark: SparkSession, d: str) -> DataFrame:
    """A1, A4: counts and shares of the total."""
    return ag.share_of_total(_t(spark, d, "documents", "source"), "source")


@query(f"SELECT count(DISTINCT {q.lt('domain')}) AS domains, count(*) AS n, sum(coalesce(llm_cost_usd, 0)) > 0 AS costs, min(llm_in_tok) AS least, max(llm_in_tok) AS most FROM classified_rows")
def totals(spark: SparkSession, d: str) -> DataFrame:
    """Distinct normal keys, sums and extremes."""
    return _t(spark, d, "classified_rows").agg(F.count_distinct(lower_trim("domain")).alias("domains"), F.count("*").alias("n"), (F.sum(F.coalesce("llm_cost_usd", F.lit(0.0))) > 0).alias("costs"), F.min("llm_in_tok").alias("least"), F.max("llm_in_tok").alias("most"))


_NEED = ["site_page", "trial_notice", "crawl_log"]


@query(f"SELECT domain FROM documents WHERE source IN ({', '.join(q.quoted(s) for s in _NEED)}) AND domain IS NOT NULL GROUP BY domain HAVING count(DISTINCT source) = 3")
def complete_domains(spark: SparkSession, d: str) -> DataFrame:
    """The domains that have every required source."""
    return ag.having_all(_t(spark, d, "documents").where("domain is not null"), "domain", "source", _NEED)


@query("""WITH f AS (SELECT domain, max(CASE WHEN status_code = 200 THEN 1 ELSE 0 END) AS a FROM page_fetch WHERE domain IS NOT NULL GROUP BY domain)
SELECT o.ord, CASE WHEN trim(coalesce(o.domain, '')) = '' THEN 'not_found' WHEN a = 1 THEN 'active' WHEN a = 0 THEN 'inactive' ELSE 'unknown' END AS status, CASE WHEN trim(coalesce(o.domain, '')) = '' THEN 'not_found' WHEN a = 1 THEN 'high' WHEN a = 0 THEN 'medium' ELSE 'low' END AS confidence FROM orgs o LEFT JOIN f USING (domain)""")
def presence_status(spark: SparkSession, d: str) -> DataFrame:
    """Active, inactive or unknown by the facts there are."""
    facts = _t(spark, d, "page_fetch", "domain", "status_code").where("domain is not null")
    return ag.presence(_t(spark, d, "orgs", "ord", "domain"), facts, "domain", F.coalesce(F.col("status_code") == 200, F.lit(False))).drop("domain")


@query("SELECT domain, count(DISTINCT source) AS n, bool_or(source NOT IN ('site_page', 'crawl_log', 'trial_notice', 'patient_faq')) AS others FROM documents WHERE source IS NOT NULL AND domain IS NOT NULL GROUP BY domain")
def source_sets(spark: SparkSession, d: str) -> DataFrame:
    """A10: the sources of each domain against an allowed set."""
    sets = _t(spark, d, "documents").where("source is not null and domain is not null").groupBy("domain").agg(F.collect_set("source").alias("s"))
    allowed = F.array(*[F.lit(s) for s in ("site_page", "crawl_log", "trial_notice", "patient_faq")])
    return sets.select("domain", F.size("s").cast("long").alias("n"), (F.size(F.array_except("s", allowed)) > 0).alias("others"))


_DELTA = "WITH a AS (SELECT domain, count(*) AS n FROM page_fetch WHERE domain IS NOT NULL GROUP BY domain), b AS (SELECT domain, count(*) AS n FROM locations WHERE domain IS NOT NULL GROUP BY domain), c AS (SELECT domain, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after FROM a FULL JOIN b USING (domain))"


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    a, b = (_t(spark, d, t, "domain").where("domain is not null").groupBy("domain").agg(F.count("*").alias("n")) for t in ("page_fetch", "locations"))
    return ag.delta(a, b, "domain")


@query(_DELTA + " SELECT CASE WHEN n_after = n_before THEN 'same' WHEN n_after > n_before THEN 'gained' ELSE 'lost' END AS kind, count(*) AS n, sum(n_after - n_before)::BIGINT AS change FROM c GROUP BY 1")
def count_changes(spark: SparkSession, d: str) -> DataFrame:
    """Keys that gained, lost or kept their count."""
    return _deltas(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.sum("change").alias("change"))


@query(_DELTA + " SELECT domain, n_after - n_before AS change FROM c ORDER BY abs(n_after - n_before) DESC, domain LIMIT 20")
def largest_changes(spark: SparkSession, d: str) -> DataFrame:
    """The 20 largest changes (a top-k report)."""
    return _deltas(spark, d).orderBy(F.abs("change").desc(), "domain").limit(20).select("domain", "change")


# Ordered operators.


@query("SELECT event_id, user_id, round((count(*) OVER w - 1) / greatest(epoch(ts) - min(epoch(ts)) OVER w, 0.001), 6) AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)")
def rolling_rates(spark: SparkSession, d: str) -> DataFrame:
    """The rate of the last 20 events of each user."""
    return od.rolling_rate(_t(spark, d, "events", "event_id", "user_id", "ts"), ["user_id"], "ts", "event_id").select("event_id", "user_id", "rate")


@query("SELECT ord FROM (SELECT ord, coalesce(sum(coalesce(llm_in_tok, 0)) OVER (PARTITION BY domain ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM classified_rows) x WHERE spent < 4000")
def within_budget(spark: SparkSession, d: str) -> DataFrame:
    """Rows admitted while the cost so far is below a cap."""
    return od.until_cap(_t(spark, d, "classified_rows", "ord", "domain", "llm_in_tok"), ["domain"], "llm_in_tok", 4000.0).select("ord")


@query("SELECT domain, ord, row_no, ok, blocked FROM (SELECT domain, ord, row_number() OVER (PARTITION BY domain ORDER BY ord) AS row_no, sum(CASE WHEN source = 'crawl' THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS ok, sum(CASE WHEN confidence = 'high' THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS blocked FROM locations) x WHERE row_no % 5 = 0")
def running_totals(spark: SparkSession, d: str) -> DataFrame:
    """Running counters at every fifth row."""
    flags = {"ok": F.coalesce(F.col("source") == "crawl", F.lit(False)), "blocked": F.coalesce(F.col("confidence") == "high", F.lit(False))}
    return od.running_counts(_t(spark, d, "locations", "domain", "ord", "source", "confidence"), ["domain"], flags, 5)


_CRAWL = "SELECT ord, domain, CASE WHEN tier_no = 1 THEN 'hub' ELSE 'page' END AS kind, CASE WHEN status_code = 200 THEN 1 ELSE 0 END AS found FROM page_fetch WHERE domain IS NOT NULL"


@query(f"""WITH r AS ({_CRAWL}), a AS (SELECT *, sum(found) OVER w AS run, max(CASE WHEN found > 0 AND kind = 'hub' THEN 1 ELSE 0 END) OVER w AS hub FROM r WINDOW w AS (PARTITION BY domain ORDER BY ord ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, sum(CASE WHEN found = 0 AND kind = 'page' THEN 1 ELSE 0 END) OVER (PARTITION BY domain, run ORDER BY ord ROWS UNBOUNDED PRECEDING) AS streak FROM a), c AS (SELECT *, min(CASE WHEN streak >= 2 AND hub = 1 THEN ord END) OVER (PARTITION BY domain) AS stop FROM b)
SELECT ord, domain FROM c WHERE stop IS NULL OR ord <= stop""")
def early_stopped(spark: SparkSession, d: str) -> DataFrame:
    """W4, X10, St5: a crawl ends after a streak of empty pages once a hub has given something."""
    rows = _t(spark, d, "page_fetch").where("domain is not null").select("ord", "domain", F.when(F.col("tier_no") == 1, "hub").otherwise("page").alias("kind"), F.when(F.col("status_code") == 200, 1).otherwise(0).alias("found"))
    return od.early_stop(rows, ["domain"], "kind", "found", 2).select("ord", "domain")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR || ':7'), doc_id) AS k FROM documents WHERE source IS NOT NULL) x WHERE k <= 5")
def sampled(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of five documents of each source (sampling is the feature)."""
    return od.sample_per_group(_t(spark, d, "documents", "source", "doc_id").where("source is not null"), ["source"], "doc_id", 5)


@query("SELECT ord, domain, (row_number() OVER (PARTITION BY domain ORDER BY ord) - 1) // 15 AS batch FROM locations WHERE domain IS NOT NULL")
def batched(spark: SparkSession, d: str) -> DataFrame:
    """W12, X13, Ud8: batches of 15 within each domain."""
    rows = jo.numbered(_t(spark, d, "locations", "ord", "domain").where("domain is not null"), "ord", "no", ["domain"])
    return od.batches(rows, "no", 15).drop("no")


# Sets.


@query("SELECT domain, 'orgs' AS origin FROM orgs UNION ALL SELECT domain, 'pages' FROM page_fetch")
def all_rows(spark: SparkSession, d: str) -> DataFrame:
    """Concatenation, duplicates kept."""
    return _t(spark, d, "orgs", "domain").withColumn("origin", F.lit("orgs")).unionByName(_t(spark, d, "page_fetch", "domain").withColumn("origin", F.lit("pages")))


@query("(SELECT domain, 'both' AS kind FROM (SELECT domain FROM orgs INTERSECT SELECT domain FROM page_fetch) x) UNION ALL (SELECT domain, 'orgs' FROM (SELECT domain FROM orgs EXCEPT SELECT domain FROM page_fetch) y) UNION ALL (SELECT domain, 'any' FROM (SELECT domain FROM orgs UNION SELECT domain FROM page_fetch) z)")
def key_sets(spark: SparkSession, d: str) -> DataFrame:
    """Intersection, difference and union of keys."""
    a, b = _t(spark, d, "orgs", "domain"), _t(spark, d, "page_fetch", "domain")
    return a.intersect(b).withColumn("kind", F.lit("both")).unionByName(a.subtract(b).withColumn("kind", F.lit("orgs"))).unionByName(a.union(b).distinct().withColumn("kind", F.lit("any")))


@query("SELECT ord, len(string_split(coalesce(specialties, ''), ';')) + len(string_split(coalesce(url_specialties, ''), ';')) AS n FROM classified_rows")
def joined_lists(spark: SparkSession, d: str) -> DataFrame:
    """U4: two lists one behind the other, duplicates kept."""
    both = F.concat(*[F.split(F.coalesce(c, F.lit("")), ";") for c in ("specialties", "url_specialties")])
    return _t(spark, d, "classified_rows").select("ord", F.size(both).cast("long").alias("n"))


@query("SELECT ord, 'Find the offices of ' || coalesce(canonical_org_name__value, '') || ' on ' || coalesce(domain, '') || ' as {json}.' AS prompt FROM orgs")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    """A text template filled for each row; other braces stay."""
    return _t(spark, d, "orgs").select("ord", filled("Find the offices of {name} on {domain} as {json}.", {"name": "canonical_org_name__value", "domain": "domain"}).alias("prompt"))


# Scores: each run of an organisation against the latest run of its domain.

def _sql_match(f: str, e: str, a: str) -> str:
    exact = {
        "canonical_org_name": f"contains({q.lt(a)}, {q.lt(e)}) OR contains({q.lt(e)}, {q.lt(a)})", "hq_phone": f"{q.norm_phone(e)} <> '' AND {q.norm_phone(e)} = {q.norm_phone(a)}",
        "hq_address": rf"(regexp_extract({q.lt(e)}, '^(\d+)', 1) <> '' AND contains({q.lt(a)}, regexp_extract({q.lt(e)}, '^(\d+)', 1))) OR (regexp_extract({q.lt(e)}, '\b([a-z]{{4,}})\b', 1) <> '' AND contains({q.lt(a)}, regexp_extract({q.lt(e)}, '\b([a-z]{{4,}})\b', 1)))",
        "location_count": rf"len(list_intersect(regexp_extract_all({q.cl(e)}, '\d+\+?'), regexp_extract_all({q.cl(a)}, '\d+\+?'))) > 0", "research_url": f"{q.norm_url(e)} = {q.norm_url(a)}", "org_subcategory": f"{q.lt(e)} = {q.lt(a)}",
    }[f]
    soft = {
        "hq_address": rf"regexp_extract({q.lt(e)}, '\b([a-z]{{2}})\b', 1) <> '' AND contains({q.lt(a)}, regexp_extract({q.lt(e)}, '\b([a-z]{{2}})\b', 1))",
        "location_count": rf"len(list_intersect(regexp_extract_all({q.cl(e)}, '\d+'), regexp_extract_all({q.cl(a)}, '\d+'))) > 0", "research_url": f"{q.url_host(e)} = {q.url_host(a)}",
    }.get(f, "false")
    first = rf"WHEN {q.cl(e)} <> '' AND {q.cl(a)} <> '' AND len(regexp_extract_all({q.cl(e)}, '\d+\+?')) = 0 THEN 'skip'" if f == "location_count" else ""
    return f"CASE {first} WHEN {q.cl(e)} = '' THEN 'skip' WHEN {q.cl(a)} = '' THEN 'miss' WHEN {exact} THEN 'exact' WHEN {soft} THEN 'soft' ELSE 'miss' END"


_TRUTH = "(SELECT domain, " + ", ".join(f"arg_max(coalesce({f}__value, ''), ord) AS e_{f}" for f in FIELDS) + " FROM orgs WHERE domain IS NOT NULL GROUP BY domain)"
_SCORED = "SELECT o.ord, o.domain, f.field, f.match FROM (" + " UNION ALL ".join(f"SELECT o.ord, o.domain, '{f}' AS field, {_sql_match(f, f'g.e_{f}', f'o.{f}__value')} AS match FROM orgs o JOIN {_TRUTH} g USING (domain)" for f in FIELDS) + ") f JOIN orgs o USING (ord)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "orgs").where("domain is not null")
    truth = jo.last_per_key(rows.select("ord", "domain", *[F.coalesce(f"{f}__value", F.lit("")).alias(f"e_{f}") for f in FIELDS]), ["domain"]).drop("ord", "first_ord")
    met = rows.join(truth, "domain")
    graded = met.select("ord", "domain", *[COMPARATORS[f](f"e_{f}", f"{f}__value").alias(f) for f in FIELDS])
    return rs.unpivot(graded, ["ord", "domain"], FIELDS, {"match": "{}"})


@query(_SCORED)
def scores(spark: SparkSession, d: str) -> DataFrame:
    """C1-C6, Ud1, S17: the comparators' verdicts of each field."""
    return _scored(spark, d)


@query(f"WITH s AS ({_SCORED}), c AS (SELECT field, count(*) FILTER (match IN ('exact', 'soft')) AS hits, count(*) FILTER (match = 'miss') AS misses, count(*) FILTER (match = 'skip') AS skips FROM s GROUP BY field) SELECT field, hits, misses, skips, hits + misses AS scored, CASE WHEN hits + misses = 0 THEN 'n/a' ELSE round_even(hits * 100 / (hits + misses), 0)::INT || '%' END AS accuracy FROM c")
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Hits, misses and accuracy of each field."""
    counts = ag.graded_counts(_scored(spark, d), ["field"])
    return counts.withColumn("accuracy", ag.percent(F.col("hits"), F.col("scored")))


@query(f"SELECT field, ord, rank FROM (SELECT field, ord, row_number() OVER (PARTITION BY field ORDER BY ord) AS rank FROM ({_SCORED}) s WHERE match = 'miss') x WHERE rank <= 5")
def first_misses(spark: SparkSession, d: str) -> DataFrame:
    """Five misses of each field (a top-k report)."""
    return od.first_k(_scored(spark, d).where("match = 'miss'"), ["field"], [F.col("ord")], 5).select("field", "ord", "rank")


# Scalar families.


@query(r"SELECT ord, regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]', '', 'g') AS key, length(text) AS chars, strftime(collected_at, '%Y-%m-%dT%H:%M:%SZ') AS at, epoch(date_trunc('second', collected_at))::BIGINT AS seconds, date_diff('day', collected_at::DATE, loaded_at::DATE) AS days FROM (SELECT doc_id AS ord, * FROM documents) x")
def text_and_dates(spark: SparkSession, d: str) -> DataFrame:
    """Keys of text, and dates as text, seconds and differences."""
    at = F.col("collected_at")
    return _t(spark, d, "documents").select(F.col("doc_id").alias("ord"), alnum_key("title").alias("key"), F.length("text").cast("long").alias("chars"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"), F.unix_timestamp(at).alias("seconds"), F.datediff("loaded_at", at).cast("long").alias("days"))


@query(r"SELECT ord, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(snippet, ''), '\n{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS squeezed, md5(coalesce(snippet, '')) AS hash FROM locations")
def squeezed_text(spark: SparkSession, d: str) -> DataFrame:
    """White space squeezed, and a hash."""
    return _t(spark, d, "locations").select("ord", F.trim(squeeze("snippet")).alias("squeezed"), F.md5(F.coalesce("snippet", F.lit(""))).alias("hash"))


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, round(value, 1) AS rounded, ceil(value / 15)::BIGINT AS batches, least(pow(2, event_id % 8), 30)::BIGINT AS backoff FROM events")
def json_and_math(spark: SparkSession, d: str) -> DataFrame:
    """M2, M4, M5: a case-insensitive key of a JSON object, rounding, batches and capped powers."""
    props = F.transform_keys(F.from_json("props", "map<string,bigint>"), lambda k, _: F.lower(k))
    return _t(spark, d, "events").select("event_id", F.try_element_at(props, F.lit("k")).alias("k"), F.round("value", 1).alias("rounded"), F.ceil(F.col("value") / 15).alias("batches"), F.least(F.pow(F.lit(2), F.col("event_id") % 8), F.lit(30)).cast("long").alias("backoff"))


@query("SELECT vec_id, len(embedding) AS n, round(list_max(embedding)::DOUBLE, 6) AS top, list_slice([i for i in range(1, 4)], 2, 3) = [2, 3] AS sliced, len(list_filter(embedding, lambda x: x > 0)) > 0 AS some_positive FROM embeddings")
def array_functions(spark: SparkSession, d: str) -> DataFrame:
    """M3: sizes, extremes, slices and predicates of arrays."""
    e = F.col("embedding")
    sliced = F.slice(F.sequence(F.lit(1), F.lit(3)), 2, 2) == F.array(F.lit(2), F.lit(3))
    return _t(spark, d, "embeddings").select("vec_id", F.size(e).cast("long").alias("n"), F.round(F.array_max(e).cast("double"), 6).alias("top"), sliced.alias("sliced"), F.exists(e, lambda x: x > 0).alias("some_positive"))
