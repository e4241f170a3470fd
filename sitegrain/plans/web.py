"""Queries of fetched pages, links and sitemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions import pages as pg
from sitegrain.functions import urls as ul
from sitegrain.functions.text import clean, contains_any
from sitegrain.functions.tree import page_facts
from sitegrain.operators.aggregate import children
from sitegrain.operators.dedupe import distinct_first, first_success
from sitegrain.operators.joins import numbered
from sitegrain.operators.ordered import first_k, with_fallback
from sitegrain.plans import sqltext as q
from sitegrain.plans.registry import query
from sitegrain.sources.tables import table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_fetch")


H = "coalesce(html, '')"
_CHALLENGED = f"({q.contains_any('html', pg.CHALLENGE)} OR (length({H}) < {pg.SMALL} AND {q.contains_any('html', pg.NETWORK)}))"
_VISIBLE = rf"trim(regexp_replace(regexp_replace(regexp_replace({H}, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"
_STATUS = "coalesce(status_code, 0)"


@query(f"""SELECT ord, {_STATUS} <> 0 AND ({q.contains_any('final_url', pg.PARKED_URL)} OR ({_STATUS} = 200 AND length({H}) < {pg.TINY}) OR (length({H}) < {pg.SMALL} AND {q.contains_any('html', pg.PARKED_TEXT)})) AS parked,
  {_STATUS} IN (403, 429, 503) OR length({H}) < {pg.TINY} OR {_CHALLENGED} AS blocked, coalesce(status_code = 200, false) AND length({H}) > {pg.SMALL} AS real_content FROM page_fetch""")
def fetch_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Parked, blocked and real pages."""
    return _pages(spark, d).select("ord", pg.is_parked("html", "final_url", "status_code").alias("parked"), pg.is_blocked("status_code", "html").alias("blocked"), pg.is_real_content("status_code", "html").alias("real_content"))


@query(rf"""WITH t AS (SELECT ord, error, {_VISIBLE} AS v FROM page_fetch)
SELECT ord, regexp_matches(lower(substr(v, 1, 6000)), {q.quoted(pg.HARD_BLOCK)}) OR (length(v) < 2500 AND regexp_matches(lower(substr(v, 1, 6000)), {q.quoted(pg.SOFT_BLOCK)})) AS block_page,
  CASE WHEN {q.contains_any('error', pg.DNS_ERROR)} THEN 'dns' WHEN {q.contains_any('error', pg.SSL_ERROR)} THEN 'ssl' ELSE '' END AS error_kind FROM t""")
def block_pages(spark: SparkSession, d: str) -> DataFrame:
    """block pages by their text, and the class of an error."""
    rows = _pages(spark, d).select("ord", "error", pg.visible_text("html").alias("v"))
    return rows.select("ord", pg.is_block_page("v").alias("block_page"), pg.error_class("error").alias("error_kind"))


@query(f"""SELECT ord, CASE WHEN length({H}) = 0 THEN 'ok' WHEN {_CHALLENGED} THEN 'challenge' WHEN {q.contains_any('html', pg.LOGIN)} THEN 'login_wall' WHEN length({H}) < {pg.LARGE} AND {q.contains_any('html', pg.SOON)} THEN 'coming_soon'
  WHEN length({H}) >= {pg.LARGE} AND length({_VISIBLE}) < {pg.SHELL} THEN 'spa_shell' ELSE 'ok' END AS quality, length({_VISIBLE}) AS visible_chars FROM page_fetch""")
def content_qualities(spark: SparkSession, d: str) -> DataFrame:
    """H1, H2: content quality and visible text."""
    return _pages(spark, d).select("ord", pg.content_quality("html").alias("quality"), F.length(pg.visible_text("html")).cast("long").alias("visible_chars"))


def _inner(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


_HEADS = " || ".join(rf"regexp_extract_all({H}, '(?is)<h{i}\b[^>]*>(.*?)</h{i}>', 1)" for i in (1, 2, 3))


@query(rf"""SELECT ord, {_inner(f"regexp_extract({H}, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, array_to_string([x for x in [{_inner('h')} for h in ({_HEADS})] if x <> '' AND length(x) <= 200], ' | ') AS headings,
  substr({_inner(f"regexp_extract({H}, '(?is)<footer\\b[^>]*>(.*?)</footer>', 1)")}, 1, 1500) AS footer, len(regexp_extract_all({H}, '(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>', 1)) AS n_json_ld FROM page_fetch""")
def page_parts(spark: SparkSession, d: str) -> DataFrame:
    """Title, headings, footer and structured data."""
    return _pages(spark, d).select("ord", pg.page_title("html").alias("title"), F.array_join(pg.headings("html"), " | ").alias("headings"), pg.footer_text("html").alias("footer"), F.size(pg.json_ld("html")).cast("long").alias("n_json_ld"))


@query()
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """H3, H4: all labelled parts of a page as one text, and whether its raw text is needed beside it."""
    rows = _pages(spark, d).withColumn("sections", pg.page_sections("html", "url"))
    return rows.select("ord", "sections", pg.needs_raw_text("html", "sections").alias("raw_needed"))


@query(r"""WITH j AS (SELECT ord, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>', 1)) AS j FROM page_fetch)
SELECT ord, json_extract_string(j, '$."@type"') AS type, json_extract_string(j, '$.name') AS name, json_extract_string(j, '$.telephone') AS telephone, json_extract_string(j, '$.address') AS address FROM j WHERE json_extract_string(j, '$."@type"') IS NOT NULL""")
def structured_facts(spark: SparkSession, d: str) -> DataFrame:
    """H5: the facts of ld+json objects."""
    return _pages(spark, d).select("ord", F.explode(pg.structured_data("html")).alias("x")).select("ord", "x.*")


@query()
def page_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of maps, data attributes, microdata, scripts and structured data, each once a page."""
    found = {"map": pg.map_addresses("html"), "data": pg.data_addresses("html"), "microdata": pg.microdata("html"), "script": pg.script_addresses("html"), "json_ld": F.filter(F.transform(pg.structured_data("html"), lambda x: x["address"]), lambda a: a.isNotNull())}
    each = F.flatten(F.array(*[F.transform(v, lambda t, k=k: F.struct(F.lit(k).alias("kind"), t.alias("address"))) for k, v in found.items()]))
    return _pages(spark, d).select("ord", F.explode(each).alias("x")).select("ord", "x.kind", "x.address").distinct()


@query(rf"""SELECT ord, array_to_string([x for x in [{_inner('p')} for p in regexp_extract_all({H}, '(?is)<p\b[^>]*>(.*?)</p>', 1)] if x <> ''], chr(10)) AS body FROM page_fetch""")
def paragraph_texts(spark: SparkSession, d: str) -> DataFrame:
    """The main content by a plain rule."""
    return _pages(spark, d).select("ord", pg.main_text("html").alias("body"))


_PLAIN = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(p, '^.*?</h[1-4][^>]*>', '', 'is'), '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"""WITH b AS (SELECT ord, unnest([{{'heading': {_inner("regexp_extract(p, '(?is)^(.*?)</h[1-4]', 1)")}, 'text': {_PLAIN}}} for p in string_split_regex({H}, '(?i)<h[1-4]\b[^>]*>')[2:]]) AS b FROM page_fetch)
SELECT ord, b.heading AS heading, regexp_extract(b.text, '\b\d{{5}}\b', 0) AS zip, length(b.text) AS chars FROM b WHERE b.heading <> '' AND length(b.heading) <= 100 AND regexp_matches(b.text, '\b\d{{5}}\b')""")
def named_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Headings whose text has a number like a postal code."""
    blocks = _pages(spark, d).select("ord", F.explode(pg.heading_blocks("html")).alias("b")).select("ord", "b.heading", "b.text")
    return blocks.where(F.col("text").rlike(r"\b\d{5}\b")).select("ord", "heading", F.regexp_extract("text", r"\b\d{5}\b", 0).alias("zip"), F.length("text").cast("long").alias("chars"))


@query()
def page_tree_facts(spark: SparkSession, d: str) -> DataFrame:
    """Maps, data attributes, microdata by scope, named headings and footers, by the page's tree."""
    return page_facts(_pages(spark, d))


_LINKS = rf"""SELECT ord, domain, i AS pos, CASE WHEN regexp_matches(u, '(?i)^https?://') THEN u WHEN starts_with(u, '//') THEN 'https:' || u WHEN starts_with(u, '/') THEN 'https://' || domain || u ELSE 'https://' || domain || '/' || u END AS link
FROM (SELECT ord, domain, l[i] AS u, i FROM (SELECT ord, domain, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT ord, domain, [x for x in regexp_extract_all({H}, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)', 1) if NOT regexp_matches(lower(x), '^(#|mailto:|tel:|javascript:)')] AS l FROM page_fetch WHERE domain IS NOT NULL) a) b) c"""


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """(ord, domain, pos, link): the links of each page in order."""
    rows = _pages(spark, d).where("domain is not null")
    return rows.select("ord", "domain", F.posexplode(ul.links("html", "domain")).alias("pos", "link")).withColumn("pos", F.col("pos") + 1)


_SITE = rf"(SELECT *, {q.url_host('link')} AS h, regexp_replace(lower(domain), '^www\.', '') AS own FROM ({_LINKS}) y)"


@query(f"SELECT domain, link, min(ord * 100000 + pos) AS first_at FROM {_SITE} z WHERE h = own OR ends_with(h, '.' || own) GROUP BY domain, link QUALIFY row_number() OVER (PARTITION BY domain ORDER BY min(ord * 100000 + pos)) <= 100")
def internal_links(spark: SparkSession, d: str) -> DataFrame:
    """The first 100 distinct internal links of each site (the cap is the feature)."""
    rows = page_links(spark, d).where(ul.is_internal(F.col("link"), "domain"))
    once = rows.groupBy("domain", "link").agg(F.min(F.col("ord") * 100_000 + F.col("pos")).alias("first_at"))
    return first_k(once, ["domain"], [F.col("first_at")], 100).drop("rank")


@query(f"SELECT domain, link, regexp_matches(link, '{ul.LOCATION_HINT}') AND NOT regexp_matches(link, '{ul.SKIP_HINT}') AS signal FROM (SELECT DISTINCT domain, link, h, own FROM {_SITE} z) w WHERE h = own")
def location_links(spark: SparkSession, d: str) -> DataFrame:
    """The distinct links within the host itself and whether they speak of places."""
    rows = page_links(spark, d)
    own = ul.url_host("link") == F.regexp_replace(F.lower("domain"), r"^www\.", "")
    return rows.where(own).select("domain", "link").distinct().withColumn("signal", ul.has_location_signal("link"))


_PLACE_URLS = "(SELECT domain, source_url AS url, min(ord) AS ord FROM locations WHERE trim(coalesce(source_url, '')) <> '' AND domain IS NOT NULL GROUP BY domain, source_url)"


@query(f"""WITH a AS (SELECT *, CASE WHEN {q.url_host('url')} = lower(domain) AND regexp_matches(url, '{ul.LOCATION_HINT}') AND NOT regexp_matches(url, '{ul.SKIP_HINT}') THEN 0 WHEN len({q.segments('url')}) > 0 AND NOT regexp_matches(url, '{ul.SKIP_HINT}') THEN 1 ELSE 2 END AS level FROM {_PLACE_URLS} x),
b AS (SELECT *, min(level) OVER (PARTITION BY domain) AS best FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ord) AS k FROM b WHERE level = best)
SELECT domain, url FROM c WHERE best < 2 OR k <= 30""")
def location_urls(spark: SparkSession, d: str) -> DataFrame:
    """a site's location pages; else its inner pages; else its first 30."""
    rows = table(spark, d, "locations").where((clean("source_url") != "") & F.col("domain").isNotNull()).groupBy("domain", F.col("source_url").alias("url")).agg(F.min("ord").alias("ord"))
    own = (ul.url_host("url") == F.lower("domain")) & ul.has_location_signal("url")
    inner = (F.size(ul.segments("url")) > 0) & ~F.col("url").rlike(ul.SKIP_HINT)
    return with_fallback(rows, ["domain"], [own, inner], 30).select("domain", "url")


# Pages that a site with places often has.
SEED_PATHS = ["locations", "our-locations", "contact", "contact-us", "find-a-location"]


@query(f"SELECT domain, 'https://' || domain || '/' || p AS url FROM (SELECT DISTINCT domain, unnest([{', '.join(q.quoted(p) for p in SEED_PATHS)}]) AS p FROM orgs WHERE domain IS NOT NULL) x WHERE lower(domain || '/' || p) NOT IN (SELECT {q.dedup_key('url')} FROM page_fetch WHERE url IS NOT NULL)")
def seeded_urls(spark: SparkSession, d: str) -> DataFrame:
    """usual location pages of each site that were not met yet."""
    sites = table(spark, d, "orgs").where("domain is not null").select("domain").distinct()
    seeds = sites.select("domain", F.explode(F.array(*[F.concat(F.lit("https://"), "domain", F.lit(f"/{p}")) for p in SEED_PATHS])).alias("url")).withColumn("key", ul.dedup_key("url"))
    seen = _pages(spark, d).where("url is not null").select(ul.dedup_key("url").alias("key")).distinct()
    return seeds.join(seen, "key", "left_anti").select("domain", "url")


@query(f"""SELECT ord, {q.norm_url('source_url')} AS norm, {q.dedup_key('source_url')} AS dedup, {q.url_host('source_url')} AS host, regexp_replace(regexp_replace(coalesce(source_url, ''), '[?#].*$', ''), '/+$', '') AS page,
  '/' || array_to_string(({q.segments('source_url')})[1:greatest(len({q.segments('source_url')}) - 1, 0)], '/') AS parent, len({q.segments('source_url')}) AS depth FROM locations""")
def url_keys(spark: SparkSession, d: str) -> DataFrame:
    """URL keys, hosts and paths."""
    s = "source_url"
    return table(spark, d, "locations").select("ord", ul.norm_url(s).alias("norm"), ul.dedup_key(s).alias("dedup"), ul.url_host(s).alias("host"), ul.page_url(s).alias("page"), ul.parent_path(s).alias("parent"), F.size(ul.segments(s)).cast("long").alias("depth"))


@query(f"""WITH a AS (SELECT ord, domain, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS page, {q.segments('url')} AS s FROM page_fetch WHERE trim(coalesce(url, '')) <> '' AND domain IS NOT NULL
  UNION ALL SELECT ord, domain, regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/+$', ''), {q.segments('source_url')} FROM locations WHERE trim(coalesce(source_url, '')) <> '' AND domain IS NOT NULL)
SELECT domain, array_to_string(s[1:len(s) - 1], '/') AS parent, count(DISTINCT page) AS n_children FROM a WHERE len(s) >= 2 GROUP BY 1, 2 HAVING count(DISTINCT page) >= 2""")
def hub_pages(spark: SparkSession, d: str) -> DataFrame:
    """The paths that have two or more pages below them."""
    both = [table(spark, d, t).where((clean(c) != "") & F.col("domain").isNotNull()).select("domain", F.col(c).alias("url")) for t, c in (("page_fetch", "url"), ("locations", "source_url"))]
    rows = both[0].unionByName(both[1]).select("domain", ul.page_url("url").alias("page"), ul.segments("url").alias("s")).where("size(s) >= 2")
    rows = rows.withColumn("parent", F.array_join(F.slice("s", 1, F.size("s") - 1), "/"))
    return children(rows, ["domain", "parent"], "page")


_KIND = "CASE WHEN path = '' THEN 0 WHEN contains(path, 'contact') THEN 1 ELSE 2 END"


@query(f"""WITH a AS (SELECT ord, domain, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS page, array_to_string({q.segments('url')}, '/') AS path FROM page_fetch WHERE trim(coalesce(url, '')) <> '' AND domain IS NOT NULL),
b AS (SELECT domain, page, min({_KIND}) AS kind, min(ord) AS ord FROM a GROUP BY domain, page)
SELECT domain, page, kind, row_number() OVER (PARTITION BY domain ORDER BY kind, ord) AS place FROM b""")
def candidate_pages(spark: SparkSession, d: str) -> DataFrame:
    """A site's pages in the order in which they are tried: home, contact, others."""
    rows = _pages(spark, d).where((clean("url") != "") & F.col("domain").isNotNull())
    path = F.array_join(ul.segments("url"), "/")
    kind = F.when(path == "", 0).when(path.contains("contact"), 1).otherwise(2)
    once = rows.select("domain", ul.page_url("url").alias("page"), kind.alias("kind"), "ord").groupBy("domain", "page").agg(F.min("kind").alias("kind"), F.min("ord").alias("ord"))
    return numbered(once.withColumn("at", F.col("kind") * (1 << 40) + F.col("ord")), "at", "place", ["domain"]).select("domain", "page", "kind", "place")


_LABELS = ", ".join(f"CASE WHEN contains(path, '{k}') THEN '{v}' END" for k, v in ul.SPECIALTY_OF_PATH.items())


@query(f"WITH a AS (SELECT domain, '/' || array_to_string({q.segments('url')}, '/') AS path FROM page_fetch WHERE domain IS NOT NULL) SELECT domain, label FROM (SELECT DISTINCT domain, unnest([{_LABELS}]) AS label FROM a) x WHERE label IS NOT NULL")
def mined_specialties(spark: SparkSession, d: str) -> DataFrame:
    """The specialties that the paths of a site name."""
    return _pages(spark, d).where("domain is not null").select("domain", F.explode(ul.specialties_of("url")).alias("label")).distinct()


@query(r"SELECT DISTINCT domain, translate(regexp_replace(domain, '\.[^.]*$', ''), '-_', '  ') AS words, 'https://www.' || domain AS second_try FROM orgs WHERE domain IS NOT NULL")
def domain_words(spark: SparkSession, d: str) -> DataFrame:
    """A domain as words, and the second of its host variants."""
    return table(spark, d, "orgs").where("domain is not null").select("domain", ul.humanised("domain").alias("words"), F.get(ul.host_variants("domain"), 1).alias("second_try")).distinct()


@query(r"SELECT ord, regexp_extract(coalesce(source_url, ''), '[?&]utm_source=([^&#]*)', 1) AS utm, substr(regexp_replace(source_url, '[^A-Za-z0-9_.-]', '_', 'g'), 1, 80) || '__' || substr(md5(source_url), 1, 8) || '.html' AS cache_key FROM locations WHERE trim(coalesce(source_url, '')) <> ''")
def url_params(spark: SparkSession, d: str) -> DataFrame:
    """A query parameter, and the file name under which a page is kept."""
    rows = table(spark, d, "locations").where(clean("source_url") != "")
    return rows.select("ord", ul.query_param("source_url", "utm_source").alias("utm"), ul.cache_key("source_url").alias("cache_key"))


@query("""WITH a AS (SELECT ord, domain, url, tier_no, coalesce(status_code = 200, false) AND coalesce(html, '') <> '' AS ok FROM page_fetch),
b AS (SELECT *, row_number() OVER (PARTITION BY domain, url ORDER BY ok DESC, CASE WHEN ok THEN coalesce(tier_no, 99) * 100000000 + ord ELSE -(coalesce(tier_no, 99) * 100000000 + ord) END) AS k FROM a)
SELECT ord, tier_no, ok AS succeeded FROM b WHERE k = 1""")
def tier_waterfall(spark: SparkSession, d: str) -> DataFrame:
    """Of the tiers that fetched a page the first success, or the last attempt."""
    rows = _pages(spark, d).select("ord", "domain", "url", "tier_no", (F.coalesce(F.col("status_code") == 200, F.lit(False)) & (F.coalesce("html", F.lit("")) != "")).alias("ok"))
    order = F.coalesce("tier_no", F.lit(99)).cast("long") * 100_000_000 + F.col("ord")
    return first_success(rows, ["domain", "url"], order, F.col("ok")).select("ord", "tier_no", "succeeded")


_SM = "string_agg('<url><loc>' || url || '</loc></url>', '' ORDER BY ord)"


@query("SELECT DISTINCT domain, trim(url) AS loc FROM page_fetch WHERE domain IS NOT NULL AND trim(coalesce(url, '')) <> '' AND contains(lower(url), lower(domain))")
def sitemap_locs(spark: SparkSession, d: str) -> DataFrame:
    """The distinct locations of a site's sitemap that are on its own domain (sitemaps are made of the fetched pages)."""
    from sitegrain.sources.files import sitemap_entries

    maps = _pages(spark, d).where("domain is not null and trim(url) <> ''").select("domain", F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc></url>")).alias("xml"))
    return sitemap_entries(maps, "xml").where(F.contains(F.lower("loc"), F.lower("domain"))).select("domain", "loc").distinct()


@query("SELECT domain, url, regexp_matches(lower(url), 'location|office|contact') OR NOT regexp_matches(lower(url), 'blog|news|team|careers') AS kept FROM (SELECT DISTINCT domain, url FROM page_fetch WHERE url IS NOT NULL) x")
def sitemap_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Sub-sitemaps are skipped on a skip signal, unless a keep signal overrides it."""
    from sitegrain.sources.files import prune

    return _pages(spark, d).where("url is not null").select("domain", "url").distinct().withColumn("kept", prune("url", "location|office|contact", "blog|news|team|careers"))


@query(f"""WITH s AS (SELECT domain, fetch_status, content_quality, {q.lt('error')} AS e FROM orgs)
SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN contains(e, 'dns') OR {q.contains_any('e', pg.DNS_ERROR)} THEN 'dns' WHEN contains(e, 'timeout') OR contains(e, 'timed out') THEN 'timeout' WHEN contains(e, 'connection') THEN 'connection' WHEN fetch_status = 'blocked' THEN 'blocked' WHEN fetch_status = 'parked' THEN 'parked' WHEN e <> '' THEN 'other_error' ELSE 'fine' END AS bucket FROM s) x GROUP BY bucket""")
def failure_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Organisations by the first failure that holds."""
    from sitegrain.operators.aggregate import first_bucket

    e = F.col("e")
    rows = table(spark, d, "orgs").select("fetch_status", F.lower(clean("error")).alias("e"))
    bucket = first_bucket([("dns", e.contains("dns") | contains_any("e", pg.DNS_ERROR)), ("timeout", e.contains("timeout") | e.contains("timed out")), ("connection", e.contains("connection")), ("blocked", F.coalesce(F.col("fetch_status") == "blocked", F.lit(False))), ("parked", F.coalesce(F.col("fetch_status") == "parked", F.lit(False))), ("other_error", e != "")], "fine")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(f"SELECT domain, min(ord) AS ord FROM page_fetch WHERE domain IS NOT NULL AND trim(coalesce(url, '')) <> '' GROUP BY domain, {q.dedup_key('url')} HAVING {q.dedup_key('url')} NOT IN (SELECT {q.dedup_key('source_url')} FROM locations WHERE trim(coalesce(source_url, '')) <> '')")
def unseen_urls(spark: SparkSession, d: str) -> DataFrame:
    """The first page of each URL key that no place was read from yet."""
    rows = _pages(spark, d).where((clean("url") != "") & F.col("domain").isNotNull()).withColumn("key", ul.dedup_key("url"))
    seed = table(spark, d, "locations").where(clean("source_url") != "").select(ul.dedup_key("source_url").alias("key")).distinct()
    return distinct_first(rows.join(seed, "key", "left_anti").select("ord", "domain", "key"), [F.col("domain"), F.col("key")]).select("domain", "ord")
