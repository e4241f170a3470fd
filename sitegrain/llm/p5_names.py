"""Problem 5: variant spellings of names typed by people.

A name is parsed into its own words, its kind (research, clinic, ...), a state chapter and, for persons, the first
name. Distinct own words become vectors of character n-grams with TF-IDF weights. A sparse cosine join finds the pairs
above a threshold: only the rare grams that a pair above it must share are joined, cosines are then exact. Rules on the
parts drop pairs that name different entities, and average linkage groups the rest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitegrain.functions.text import is_blank
from sitegrain.llm.p2_residue import dummy_text
from sitegrain.llm.p4_addresses import one_slip
from sitegrain.llm.pairs import row_pairs
from sitegrain.sources.tables import materialize, table

# Given names with their short forms, kinds of organisation with abbreviations, titles, legal forms, labels.
GIVEN = {
    "andrew": "andy drew", "anthony": "tony", "charles": "charlie chuck chas", "daniel": "dan danny", "david": "dave", "deborah": "deb debbie debby", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty lizzie betsy eliza",
    "francisco": "paco pancho frank cisco", "gregory": "greg", "harriet": "hattie harry", "james": "jim jimmy jamie", "jennifer": "jen jenny jenn", "john": "jack johnny", "joseph": "joe joey", "katherine": "kate kathy katie kat kathryn",
    "lawrence": "larry lars", "margaret": "maggie meg peggy marge", "michael": "mike mick mickey", "nicholas": "nick nicky nico", "oliver": "ollie olly", "patricia": "pat patty trish tricia", "richard": "rich rick dick ricky",
    "robert": "rob bob bobby robbie", "steven": "steve stevie stephen", "susan": "sue susie suzy", "thomas": "tom tommy", "victoria": "vicky vicki tori", "william": "bill will billy willie liam", "yolanda": "yoli yola", "zachary": "zach zack zak",
}
KINDS = {
    "research": "rsch res resch", "center": "ctr centre cntr", "medical": "med medl", "group": "grp", "trials": "trial", "network": "netwk ntwk netw", "family": "fam", "clinic": "", "clinical": "", "institute": "inst", "physicians": "phys physician", "health": "hlth",
    "partners": "ptnrs partner prtnrs", "associates": "assoc assocs associate", "foundation": "fdn fndn found", "heart": "hrt", "vascular": "vasc", "hospital": "hosp",
}
TITLES = set("dr doctor prof professor mr mrs ms md do phd np rn dds dpm facp mph pac".split())
LEGAL = set("llc inc corp pllc pc pa ltd llp lp co company incorporated corporation".split())
SMALL = set("the and at of in for".split())
LABELS = set("hq headquarters annex main office administrative admin west east north south campus branch satellite downtown uptown central site suite building location corporate primary".split())
GIVEN_OF = {short: long for long, shorts in GIVEN.items() for short in [long, *shorts.split()]}
KIND_OF = {short: "clinic" if long == "clinical" else long for long, shorts in KINDS.items() for short in [long, *shorts.split(), *(["clin"] if long == "clinic" else [])]}

GRAM, COSINE, LINKAGE = 5, 0.4, 0.3
PARSED = "name string, core string, kind string, state string, first string"


@lru_cache(100_000)
def _kind(word: str) -> str:
    found = KIND_OF.get(word)
    if found or len(word) < 6:
        return found or ""
    near = {KIND_OF[k] for k in KINDS if len(k) >= 6 and one_slip(word, k)}
    return near.pop() if len(near) == 1 else ""


@lru_cache(100_000)
def _given(word: str) -> str:
    found = GIVEN_OF.get(word)
    if found or len(word) < 5:
        return found or ""
    near = {long for long in GIVEN if one_slip(word, long)}
    return near.pop() if len(near) == 1 else ""


def parse(name: str, states: tuple[str, ...] = ()) -> tuple[str, str, str, str]:
    """(core, kind, state, first): the name's own words in one, its kind, its chapter and a person's first name.

    ``core`` is '' for labels such as HQ and for texts without letters.
    """
    text = unicodedata.normalize("NFKC", name).lower().replace("’", "'").replace("'", "").replace(".", "" if not re.search(r"\b\w\. ?\w+\b(?<!\w\.\w)", name) else ".")
    text = re.sub(r"\b([a-z])\.(?=[a-z]\b)", r"\1", text).replace(".", " ")
    text = re.sub(r"\s+", " ", text.replace("&", " and ")).strip()
    state = ""
    for s in states if " of " in text else ():
        if re.search(rf"\bof {s}\b", text):
            state = max(state, s, key=len)
    if state:
        text = re.sub(rf"\bof {state}\b", " ", text)
    text = re.sub(r"^(the )?(practice|office|offices) of ", "dr ", text)
    head, comma, tail = text.partition(",")
    words = [w for w in re.findall(r"[^\W_]+", text) if w not in LEGAL]
    kinds = [k for w in words if (k := _kind(w))]
    own = [w for w in words if not _kind(w) and w not in SMALL]
    titled = any(w in TITLES for w in own)
    names = [w for w in own if w not in TITLES]
    if not kinds and names and (titled or (comma and len(names) == 2 and len(head.split()) == 1)) and len(names) <= 4:
        given = [w for w in names if _given(w) and w != max(names, key=len)] or [w for w in names if _given(w)][: len(names) - 1]
        initials = [w for w in names if len(w) == 1]
        rest = [w for w in names if w not in given and len(w) > 1]
        if given:
            first, family = _given(given[0]), rest
        elif len(rest) >= 2:
            first, family = (rest[-1], rest[:-1]) if comma and len(head.split()) == 1 else (rest[0], rest[1:])
        else:
            first, family = (initials[0] if initials else "?"), rest
        return "".join(family), "", state, first
    if not [w for w in own if w not in LABELS and not w.isdigit()]:
        return "", "", "", ""
    if "physicians" in kinds:  # a group of physicians is called either
        kinds = [k for k in kinds if k != "group"]
    return "".join(names), " ".join(sorted(set(kinds))), state, ""


def _grams() -> Column:
    """The distinct n-grams of ``core`` with its ends marked: of four letters for persons, of GRAM for others."""
    text = F.concat(F.lit("^"), "core", F.lit("$"))
    found = F.when(F.col("first") == "", F.regexp_extract_all(text, F.lit(f"(?=(.{{{GRAM}}}))"), 1)).otherwise(F.regexp_extract_all(text, F.lit(f"(?=(.{{{GRAM - 1}}}))"), 1))
    return F.when(F.size(found) == 0, F.array(text)).otherwise(F.array_distinct(found))


def _alike(l: str, r: str) -> Column:
    """Equal up to slips of typing: one edit from four letters on, two from seven, three from fourteen (``n`` letters)."""
    a, b, longer = F.col(f"{l}.core"), F.col(f"{r}.core"), F.greatest(f"{l}.n", f"{r}.n")
    allowed = F.when(longer >= 14, 3).when(longer >= 7, 2).when(longer >= 4, 1).otherwise(0)
    return (F.abs(F.col(f"{l}.n") - F.col(f"{r}.n")) <= 3) & (F.pmod(F.levenshtein(a, b, 3), F.lit(100)) <= allowed)  # -1, too far, becomes 99


def compatible(l: str, r: str) -> Column:
    """Nothing but the own words speaks against one entity: both persons whose first names agree (an initial agrees with
    every name that it begins), or both organisations of one chapter whose kinds agree or are missing in one.
    """
    x, y = (lambda c: F.col(f"{l}.{c}")), (lambda c: F.col(f"{r}.{c}"))
    shorter = F.least(F.length(x("first")), F.length(y("first")))
    initial = (shorter == 1) & (F.substring(x("first"), 1, 1) == F.substring(y("first"), 1, 1))
    person = (x("first") != "") & (y("first") != "") & ((x("first") == y("first")) | initial | ((shorter >= 5) & (F.levenshtein(x("first"), y("first"), 1) >= 0)))
    group = (x("first") == "") & (y("first") == "") & (x("state") == y("state")) & ((x("kind") == y("kind")) | (x("kind") == "") | (y("kind") == ""))
    return person | group


def similar(names: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b, cos), a < b: names of one scope that may be one entity and whose n-gram vectors have that cosine at least.

    ``names``: id, scope, core, kind, state, first. The grams of a name are ordered by rarity; a pair above the
    threshold must share one of the leading grams that hold all but the square of ``cosine`` of each vector's energy,
    so only these are joined. The cosine itself is summed over all grams.
    """
    listed = materialize(names.select("id", "scope", F.explode(_grams()).alias("gram")), "p5-grams")
    total = names.count()
    weights = listed.groupBy("gram").agg(F.count("*").alias("df")).select("gram", (F.log(F.lit(float(max(1, total))) / F.col("df")) + 1).alias("w"))
    weighted = materialize(listed.join(weights, "gram"), "p5-weighted")
    own = Window.partitionBy("id")
    energy = F.col("w") * F.col("w")
    before = F.coalesce(F.sum(energy).over(own.orderBy(F.col("w").desc(), "gram").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rare = weighted.select("id", "gram", before.alias("before"), F.sum(energy).over(own).alias("norm")).where(F.col("norm") - F.col("before") >= cosine * cosine * F.col("norm"))
    rare = rare.join(names, "id").select(F.xxhash64("scope", "gram", F.substring("first", 1, 1)).alias("key"), "id", "norm", "scope", "core", F.length("core").alias("n"), "kind", "state", "first")
    a, b = rare.alias("a"), rare.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")))
    met = met.where((F.col("a.scope") == F.col("b.scope")) & compatible("a", "b") & _alike("a", "b"))
    pairs = met.groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(F.first("a.norm").alias("na"), F.first("b.norm").alias("nb"))
    pairs = materialize(pairs, "p5-pairs")
    x, y = weighted.select(F.col("id").alias("a"), "gram", "w"), weighted.select(F.col("id").alias("b"), "gram")
    dots = pairs.join(x, "a").join(y, ["b", "gram"]).groupBy("a", "b", "na", "nb").agg(F.sum(energy).alias("dot"))
    return dots.select("a", "b", (F.col("dot") / F.sqrt(F.col("na") * F.col("nb"))).alias("cos")).where(F.col("cos") >= cosine)


def average_linkage(edges: DataFrame, linkage: float = LINKAGE) -> DataFrame:
    """(id, grp) for each id of ``edges`` (a, b, cos; a < b): clusters by average linkage, named by their smallest id.

    Each round merges all pairs of clusters that are each other's best, which gives the same clusters as merging one
    pair after another; pairs without an edge count as 0. The rounds end when no average reaches ``linkage``.
    """
    edges = materialize(edges.select("a", "b", F.col("cos").alias("s"), F.lit(1).cast("long").alias("na"), F.lit(1).cast("long").alias("nb")), "p5-edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("grp"))
    while True:
        mean = F.round(F.col("s") / (F.col("na") * F.col("nb")), 9)
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("o"), mean.alias("m")), F.struct(F.col("b").alias("c"), F.col("a").alias("o"), mean.alias("m")))).alias("e")).select("e.*")
        best = both.where(F.col("m") >= linkage).groupBy("c").agg(F.max_by("o", F.struct("m", -F.col("o"))).alias("o"))
        merged = materialize(best.groupBy(F.least("c", "o").alias("to"), F.greatest("c", "o").alias("c")).count().where("count = 2").select("c", "to"), "p5-merged")
        if merged.isEmpty():
            return labels
        labels = materialize(labels.join(merged.withColumnRenamed("c", "grp"), "grp", "left").select("id", F.coalesce("to", "grp").alias("grp")), "p5-labels")
        sizes = labels.groupBy("grp").agg(F.count("*").alias("n"))
        for end in ("a", "b"):
            edges = edges.join(merged.toDF(end, "to"), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        edges = edges.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s"))
        edges = edges.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
        edges = materialize(edges.select("a", "b", "s", "na", "nb"), "p5-edges")


def variant_groups(rows: DataFrame, states: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): the rows by parsed name (grp, raw, ord), and the pairs (ga, gb) of parsed names of one entity.

    ``rows``: field_name, scope, ord, name. Null, blank and dummy names, labels such as HQ and names without letters
    are in no group. Rows of one parsed name are reduced to it before any join.
    """
    named = rows.where(~is_blank("name") & ~F.coalesce(dummy_text("name"), F.lit(False)))
    schema = "field_name string, scope string, ord long, raw long, " + PARSED.partition(", ")[2]

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = lru_cache(100_000)(lambda n: parse(n, states))
        for batch in batches:
            found = [cached(n) for n in batch.column(4).to_pylist()]
            cols = [pa.array(c, pa.string()) for c in zip(*found)] if found else [pa.array([], pa.string())] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *cols], ["field_name", "scope", "ord", "raw", "core", "kind", "state", "first"])

    columns = ["field_name", F.coalesce("scope", F.lit("")).alias("scope"), F.col("ord").cast("long"), F.xxhash64("name").alias("raw"), "name"]
    each = materialize(named.select(*columns).mapInArrow(parsed, schema).where("core <> ''"), "p5-parsed")
    parts = ["field_name", "scope", "core", "kind", "state", "first"]
    code = F.min("ord") * 2 + F.when(F.col("field_name") == "canonical_org_name", 0).otherwise(1)
    names = materialize(each.groupBy(*parts).agg(code.alias("id")), "p5-names")
    members = materialize(each.join(names, parts).select(F.col("id").alias("grp"), "raw", "ord"), "p5-members")
    vectors = names.select("id", F.xxhash64("field_name", "scope").alias("scope"), "core", "kind", "state", "first")
    groups = average_linkage(similar(vectors)).join(vectors, "id")
    a, b = groups.alias("a"), groups.alias("b")
    pairs = a.join(b, (F.col("a.grp") == F.col("b.grp")) & (F.col("a.id") < F.col("b.id"))).where(compatible("a", "b"))
    return members, pairs.select(F.col("a.id").alias("ga"), F.col("b.id").alias("gb"))


def _rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple[str, ...]]:
    orgs = table(spark, sf_dir, "orgs").select(F.lit("canonical_org_name").alias("field_name"), F.lit("").alias("scope"), "ord", F.col("canonical_org_name__value").alias("name"))
    places = table(spark, sf_dir, "locations").where("domain is not null").select(F.lit("location_name").alias("field_name"), F.col("domain").alias("scope"), "ord", F.col("location_name").alias("name"))
    states = table(spark, sf_dir, "state_ref").select(F.lower("state_name")).collect()
    return orgs.unionByName(places), tuple(sorted(r[0] for r in states if r[0]))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows whose names differ but name the same organisation, site or practitioner."""
    members, pairs = variant_groups(*_rows(spark, sf_dir))
    org = members.where("grp % 2 = 0"), pairs.where("ga % 2 = 0")
    place = members.where("grp % 2 = 1"), pairs.where("ga % 2 = 1")
    found = [row_pairs(*x).select(F.lit(f).alias("field_name"), "ord_a", "ord_b") for f, x in (("canonical_org_name", org), ("location_name", place))]
    return found[0].unionByName(found[1])


def p5_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, ord, entity): each named row with the smallest row of its cluster."""
    members, pairs = variant_groups(*_rows(spark, sf_dir))
    least = pairs.groupBy(F.col("gb").alias("grp")).agg(F.min("ga").alias("head"))
    field = F.when(F.col("grp") % 2 == 0, "canonical_org_name").otherwise("location_name")
    return members.join(least, "grp", "left").select(field.alias("field_name"), "ord", F.expr("coalesce(head, grp) div 2").alias("entity"))
