"""Workflows: compositions of the operators from fetched pages to profiles, places and reports.

Where a service outside of the engine would decide, a rule does by default: ``plan``, ``profiles``, ``page_places`` and
``labelled`` are plug points that take a frame of other results in the same columns instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions import addresses as ad
from sitegrain.functions import pages as pg
from sitegrain.functions import urls as ul
from sitegrain.functions.text import clean, is_blank, lower_trim
from sitegrain.operators.aggregate import share_of_total
from sitegrain.operators.dedupe import first_success
from sitegrain.operators.joins import last_per_key, lookup
from sitegrain.operators.ordered import first_k
from sitegrain.plans import places, web
from sitegrain.plans import sqltext as q
from sitegrain.plans.registry import query
from sitegrain.sources.tables import table

# What makes a page worth reading, from the best priority down, and what rules it out.
PRIORITIES = [(1, r"/contact|/get-in-touch"), (2, r"trial|stud(y|ies)|research"), (3, r"location|/sites|find-a"), (4, r"/about|/patients|recruit|participate")]
SKIPPED = r"\.pdf$|login|portal|news|press|career|job|privacy|legal|terms"
PHONE = r"\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}"
#: Labels by the words of a page, the first that holds.
LABELS = [("sponsor", r"\bsponsor"), ("research_site_network", r"trials network|research network|locations in"), ("hospital", r"\bhospital\b"), ("research_site", r"clinical research|research (center|institute)"), ("clinic", r"clinic|physicians|medical (group|associates|center)")]


def priority(url: Column | str) -> Column:
    """1 to 5, 5 for pages of no special use; null for pages that are skipped."""
    low = F.lower(F.col(url) if isinstance(url, str) else url)
    out = F.lit(5)
    for p, pattern in reversed(PRIORITIES):
        out = F.when(low.rlike(pattern), p).otherwise(out)
    return F.when(~low.rlike(SKIPPED), out)


def plan(links: DataFrame, most: int = 7) -> DataFrame:
    """(domain, link, priority, place): the ``most`` best links of each site, by priority and then by order.

    ``links``: domain, link, first_at. A site's links that are all skipped give no row.
    """
    ranked = links.withColumn("priority", priority("link")).where("priority is not null")
    return first_k(ranked, ["domain"], [F.col("priority"), F.col("first_at")], most).select("domain", "link", "priority", F.col("rank").alias("place"))


_PRIORITY = "CASE " + " ".join(f"WHEN regexp_matches(lower(link), {q.quoted(p)}) THEN {i}" for i, p in PRIORITIES) + " ELSE 5 END"
_INTERNAL = f"SELECT domain, link, min(ord * 100000 + pos) AS first_at FROM {web._SITE} z WHERE h = own OR ends_with(h, '.' || own) GROUP BY domain, link"


@query(f"SELECT domain, link, priority, place FROM (SELECT domain, link, {_PRIORITY} AS priority, row_number() OVER (PARTITION BY domain ORDER BY {_PRIORITY}, first_at) AS place FROM ({_INTERNAL}) a WHERE NOT regexp_matches(lower(link), {q.quoted(SKIPPED)})) b WHERE place <= 7")
def planned_pages(spark: SparkSession, d: str) -> DataFrame:
    """Ud4, Ud5, Ud7, F19: the seven pages of a site that are read first (the cap is the feature)."""
    rows = web.page_links(spark, d).where(ul.is_internal(F.col("link"), "domain"))
    return plan(rows.groupBy("domain", "link").agg(F.min(F.col("ord") * 100_000 + F.col("pos")).alias("first_at")))


def best_pages(pages: DataFrame) -> DataFrame:
    """The best attempt at each page: the first tier with html of status 200."""
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False)) & (F.coalesce("html", F.lit("")) != "")
    order = F.coalesce("tier_no", F.lit(99)).cast("long") * 100_000_000 + F.col("ord")
    return first_success(pages, ["domain", "url"], order, ok).where("succeeded")


def profiles(pages: DataFrame) -> DataFrame:
    """(domain, name, phone, address, phone_url): a profile of each site by rules, '' for what no page tells.

    The name is the last part of the first page's title, phone and address are the first that a page has in its
    structured data, else the first phone in its text.
    """
    facts = pages.select("domain", "ord", "url", F.get(F.split(pg.page_title("html"), r"\|"), F.size(F.split(pg.page_title("html"), r"\|")) - 1).alias("t"), F.get(pg.structured_data("html"), 0).alias("s"), F.regexp_extract(pg.visible_text("html"), f"({PHONE})", 1).alias("p"))
    facts = facts.select("domain", "ord", "url", F.trim("t").alias("name"), F.coalesce(F.col("s.telephone"), "p").alias("phone"), F.coalesce(F.col("s.address"), F.lit("")).alias("address"))

    def first(c: str, value: str | None = None) -> Column:
        return F.coalesce(F.min_by(value or c, F.when(F.col(c) != "", F.col("ord"))), F.lit(""))

    return facts.groupBy("domain").agg(first("name").alias("name"), first("phone").alias("phone"), first("address").alias("address"), first("phone", "url").alias("phone_url"))


_BEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, url ORDER BY coalesce(tier_no, 99) * 100000000 + ord) AS k_ FROM page_fetch WHERE status_code = 200 AND coalesce(html, '') <> '') x WHERE k_ = 1"
_TITLE = web._inner(f"regexp_extract({web.H}, '(?is)<title[^>]*>(.*?)</title>', 1)")
_LD = rf"regexp_extract({web.H}, '(?is)<script\b[^>]*application/ld\+json[^>]*>(.*?)</script>', 1)"
PROFILES = rf"""
WITH b AS ({_BEST}), j AS (SELECT domain, ord, url, html, CASE WHEN json_valid({_LD}) THEN {_LD} END AS ld FROM b),
f AS (SELECT domain, ord, url, trim(string_split({_TITLE}, '|')[-1]) AS name, coalesce(CASE WHEN json_extract_string(ld, '$."@type"') IS NOT NULL THEN json_extract_string(ld, '$.telephone') END, regexp_extract({web._VISIBLE}, '({PHONE})', 1)) AS phone, coalesce(CASE WHEN json_extract_string(ld, '$."@type"') IS NOT NULL THEN json_extract_string(ld, '$.address') END, '') AS address FROM j)
SELECT domain, coalesce(arg_min(name, ord) FILTER (name <> ''), '') AS name, coalesce(arg_min(phone, ord) FILTER (phone <> ''), '') AS phone, coalesce(arg_min(address, ord) FILTER (address <> ''), '') AS address, coalesce(arg_min(url, ord) FILTER (phone <> ''), '') AS phone_url
FROM f GROUP BY domain
"""


@query(PROFILES)
def site_profiles(spark: SparkSession, d: str) -> DataFrame:
    """X1, Ud2: a profile of each site from its best pages."""
    return profiles(best_pages(table(spark, d, "page_fetch")))


def page_places(pages: DataFrame, states: list[str]) -> DataFrame:
    """(domain, ord, street, city, state, zip): the distinct parsed addresses of each site's structured data."""
    found = pages.select("domain", "ord", F.explode(F.filter(pg.structured_data("html"), lambda x: x["address"].isNotNull())).alias("s"))
    parsed = found.select("domain", "ord", ad.parse_address_line("s.address", states).alias("a")).select("domain", "ord", "a.*")
    key = [lower_trim(c).alias(f"k{i}") for i, c in enumerate(("domain", "street", "city", "zip"))]
    return parsed.groupBy(*key).agg(F.min_by(F.struct(*parsed.columns), "ord").alias("r")).select("r.*")


PAGE_PLACES = places.PARSED_LINE.replace("FROM orgs", "FROM (SELECT ord, json_extract_string(ld, '$.address') AS hq_address__value FROM (SELECT ord, CASE WHEN json_valid(" + _LD + ") THEN " + _LD + " END AS ld FROM page_fetch) l WHERE json_extract_string(ld, '$.\"@type\"') IS NOT NULL AND json_extract_string(ld, '$.address') IS NOT NULL) o")


@query(f"SELECT p.domain, min(a.ord) AS ord, arg_min(street, a.ord) AS street, arg_min(city, a.ord) AS city, arg_min(state, a.ord) AS state, arg_min(zip, a.ord) AS zip FROM ({PAGE_PLACES}) a JOIN page_fetch p ON p.ord = a.ord GROUP BY p.domain, lower(street), lower(city), zip")
def places_of_pages(spark: SparkSession, d: str) -> DataFrame:
    """Ud3, H14, X13: the places that a site's pages state."""
    codes = [r[0] for r in table(spark, d, "state_ref").select("state_code").collect()]  # 52 rows, a list that does not grow
    return page_places(table(spark, d, "page_fetch"), codes)


def labelled(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, label): the first label whose words any of the key's texts has, else ''. Texts are judged one by one."""
    rank = F.lit(len(LABELS))
    for i, (_, pattern) in reversed(list(enumerate(LABELS))):
        rank = F.when(F.lower(F.col(text)).rlike(pattern), i).otherwise(rank)
    names = F.array(*[F.lit(n) for n, _ in LABELS], F.lit(""))
    return texts.groupBy(key).agg(F.get(names, F.min(rank)).alias("label"))


@query("SELECT domain, CASE min(r) " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in enumerate(LABELS)) + " ELSE '' END AS label FROM (SELECT domain, CASE " + " ".join(f"WHEN regexp_matches(lower({_TITLE}), {q.quoted(p)}) THEN {i}" for i, (_, p) in enumerate(LABELS)) + " ELSE 99 END AS r FROM page_fetch WHERE coalesce(html, '') <> '' AND domain IS NOT NULL) x GROUP BY domain")
def site_labels(spark: SparkSession, d: str) -> DataFrame:
    """Ud6, X8: a label of each site by the words of its titles."""
    pages = table(spark, d, "page_fetch").where("domain is not null").where(F.coalesce("html", F.lit("")) != "")
    return labelled(pages.select("domain", pg.page_title("html").alias("t")), "domain", "t")


@query(f"WITH p AS ({PROFILES}), w AS (SELECT domain, max(ord) AS ord, arg_max(fetch_status, ord) AS s FROM orgs WHERE domain IS NOT NULL GROUP BY domain) SELECT w.ord, w.domain, CASE WHEN p.domain IS NOT NULL THEN 'ok' ELSE coalesce(w.s, 'unknown') END AS status, coalesce(p.name, '') AS name, coalesce(p.phone, '') AS phone FROM w LEFT JOIN p USING (domain)")
def enriched_orgs(spark: SparkSession, d: str) -> DataFrame:
    """Each organisation's last run, completed by what its pages tell; every organisation gives a row."""
    rows = last_per_key(table(spark, d, "orgs").where("domain is not null").select("ord", "domain", F.coalesce("fetch_status", F.lit("unknown")).alias("s")), ["domain"])
    found = site_profiles(spark, d).withColumn("ok", F.lit("ok"))
    met = lookup(rows, found, "domain", {"name": "", "phone": "", "ok": ""})
    return met.select("ord", "domain", F.when(F.col("ok") == "ok", "ok").otherwise(F.col("s")).alias("status"), "name", "phone")


@query(f"""WITH u AS (SELECT DISTINCT trim(regexp_replace(coalesce(address_street, ''), '\\b({'|'.join(ad.UNIT_WORDS)})\\b.*$', '', 'is')) AS s, {q.lt('address_city')} AS c, {q.cl('address_zip')} AS z FROM locations),
k AS (SELECT DISTINCT zip, lower(city) AS city FROM zip_dim), v AS (SELECT u.*, CASE WHEN NOT regexp_matches(s, '\\d') THEN 'no_street' WHEN k.zip IS NOT NULL THEN 'Match' WHEN z <> '' AND z IN (SELECT zip FROM zip_dim) THEN 'Tie' ELSE 'No_Match' END AS verdict FROM u LEFT JOIN k ON k.zip = u.z AND k.city = u.c)
SELECT verdict, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (SELECT v.verdict FROM locations l JOIN v ON v.s = trim(regexp_replace(coalesce(l.address_street, ''), '\\b({'|'.join(ad.UNIT_WORDS)})\\b.*$', '', 'is')) AND v.c = {q.lt('l.address_city')} AND v.z = {q.cl('l.address_zip')}) x GROUP BY verdict""")
def verified_places(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct address is judged once against the reference, every row gets its verdict, shares follow."""
    rows = table(spark, d, "locations").select(ad.strip_suite("address_street").alias("s"), lower_trim("address_city").alias("c"), clean("address_zip").alias("z"))
    zips = table(spark, d, "zip_dim")
    judged = rows.distinct().join(zips.select(F.col("zip").alias("z"), F.lower("city").alias("c"), F.lit(True).alias("both")).distinct(), ["z", "c"], "left")
    judged = judged.join(zips.select(F.col("zip").alias("z"), F.lit(True).alias("known")).distinct(), "z", "left")
    verdict = F.when(~ad.has_street("s"), "no_street").when(F.col("both"), "Match").when((F.col("z") != "") & F.col("known"), "Tie").otherwise("No_Match")
    return share_of_total(rows.join(judged.withColumn("verdict", verdict), ["s", "c", "z"]), "verdict")


@query(f"WITH n AS (SELECT ord, {q.cl('location_name')} AS name, domain, {q.cl('address_city')} AS city, {q.cl('address_state')} AS state FROM locations WHERE {q.cl('address_street')} = '' AND {q.cl('address_city')} <> '' AND {q.cl('address_state')} <> '') SELECT ord, CASE WHEN name <> '' THEN name ELSE translate(regexp_replace(coalesce(domain, ''), '\\.[^.]*$', ''), '-_', '  ') END || ' ' || city || ' ' || state AS asked FROM n")
def place_queries(spark: SparkSession, d: str) -> DataFrame:
    """The text by which a place without a street is looked for."""
    rows = table(spark, d, "locations").where(is_blank("address_street") & ~is_blank("address_city") & ~is_blank("address_state"))
    name = F.when(~is_blank("location_name"), clean("location_name")).otherwise(ul.humanised("domain"))
    return rows.select("ord", F.concat_ws(" ", name, clean("address_city"), clean("address_state")).alias("asked"))


@query("""WITH c AS (SELECT l.ord, min(z.zip) AS zip FROM locations l JOIN zip_dim z ON lower(z.city) = lower(trim(l.address_city)) AND z.state = l.address_state WHERE trim(coalesce(l.address_zip, '')) = '' GROUP BY l.ord)
SELECT l.ord, CASE WHEN trim(coalesce(l.address_zip, '')) = '' THEN coalesce(c.zip, '') ELSE l.address_zip END AS address_zip, c.zip IS NOT NULL AS changed FROM locations l LEFT JOIN c USING (ord)""")
def patched_places(spark: SparkSession, d: str) -> DataFrame:
    """Missing postal codes patched in place by the best candidate, with what changed."""
    rows = table(spark, d, "locations").select("ord", "address_city", "address_state", "address_zip")
    zips = table(spark, d, "zip_dim").groupBy(F.lower("city").alias("_c"), F.col("state").alias("_s")).agg(F.min("zip").alias("_z"))
    met = rows.join(zips, (F.lower(F.trim("address_city")) == F.col("_c")) & (F.col("address_state") == F.col("_s")), "left")
    patched = is_blank("address_zip") & F.col("_z").isNotNull()
    return met.select("ord", F.when(is_blank("address_zip"), F.coalesce("_z", F.lit(""))).otherwise(F.col("address_zip")).alias("address_zip"), patched.alias("changed"))
