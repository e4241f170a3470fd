"""Problem 7: one form for text that looks the same.

Look-alike characters are mapped to one member, then values are grouped in SQL under the accent- and case-sensitive
Unicode collation (which equates composed and combining accents). Each class takes its smallest mapped member as its
canonical form, and that form is joined back. Accents, case, punctuation, raised digits and fractions stay apart.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.functions.text import clean
from sitegrain.sources.tables import materialize, table

FIELDS = ["canonical_org_name", "hq_phone", "hq_address", "location_count", "research_url", "org_subcategory"]
# Letters of other scripts that are drawn like Latin ones, and their Latin twins, in the same order.
CYRILLIC, CYRILLIC_TWIN = "АВЕЅІЈКМНОРСТУХҮԚԜаеѕіјорсухһԁԛԝѵӏ", "ABESIJKMHOPCTYXYQWaesijopcyxhdqwvl"
GREEK, GREEK_TWIN = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονϲιρυ", "ABEZHIKMNOPTYXCjovcipu"
SPACES = "               　"
HYPHENS = "‐‑﹣"
INVISIBLE = "[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁯︀-️﻿￹-￻]"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "Ĳ": "IJ", "ĳ": "ij", "Ǉ": "LJ", "ǉ": "lj", "Ǌ": "NJ", "ǌ": "nj"}
SINGLE = {"K": "K", "Ω": "Ω", "Å": "Å", "∙": "·", ";": ";", "·": "·", "µ": "μ", "Ⅰ": "I", "Ⅴ": "V", "Ⅹ": "X", "Ⅼ": "L", "Ⅽ": "C", "Ⅾ": "D", "Ⅿ": "M", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m"}

# Wide and narrow forms of the half- and full-width block with their ordinary forms (without the filler, which is invisible), and Roman numerals of several letters.
WIDTH = {chr(c): chr(int(d.split()[1], 16)) for c in range(0xFF01, 0xFFEF) if c != 0xFFA0 and (d := unicodedata.decomposition(chr(c)))}
ROMAN = {chr(c): many for c in range(0x2160, 0x2180) if len(many := unicodedata.normalize("NFKC", chr(c))) > 1}


def is_ascii(text: Column) -> Column:
    """True where the text has ASCII characters alone; null gives null."""
    return F.octet_length(text) == F.length(text)


def _squeezed(text: Column) -> Column:
    return F.regexp_replace(text, "[ \\t\\r\\n]+", " ")


def look(text: Column) -> Column:
    """The text with wide forms, look-alike letters, spaces and hyphens mapped and invisible characters removed."""
    return F.trim(_squeezed(_mapped(text)))


def _mapped(text: Column) -> Column:
    source = "".join(WIDTH) + CYRILLIC + GREEK + SPACES + HYPHENS + "".join(SINGLE)
    target = "".join(WIDTH.values()) + CYRILLIC_TWIN + GREEK_TWIN + " " * len(SPACES) + "-" * len(HYPHENS) + "".join(SINGLE.values())
    out = F.translate(F.regexp_replace(text, INVISIBLE + "|[\uffa0\u3164]", ""), source, target)
    for one, many in (LIGATURES | ROMAN).items():
        out = F.replace(out, F.lit(one), F.lit(many))
    return out


def canonical_forms(rows: DataFrame, text: str = "snippet") -> DataFrame:
    """``rows`` with ``canonical``: equal exactly where the texts look the same.

    Null text stays null and blank text becomes ''; every other column is kept (one named ``canonical`` is replaced), one row for
    each input row. Texts of
    any length are compared whole. Classes of one mapped text are their own canonical form, so that only texts that the collation
    merges (composed against combining accents) are joined back. Text of ASCII alone is its own form and takes no part
    in the collation.
    """
    others = [c for c in rows.columns if c != "canonical"]
    packed = rows.select(F.struct(*others).alias("row"), F.col(text).alias("text"))
    plain = packed.where(F.col("text").isNull() | is_ascii(F.col("text"))).select("row", F.trim(_squeezed(F.col("text"))).alias("canonical"))
    marked = materialize(packed.where(~is_ascii(F.col("text"))).select("row", look(F.col("text")).alias("look")), "p7-looks")
    turned = marked.where(is_ascii(F.col("look"))).withColumnRenamed("look", "canonical")
    kept = marked.where(~is_ascii(F.col("look")))
    classes = kept.groupBy(F.collate("look", "UNICODE").alias("class")).agg(F.min("look").alias("first"), F.max("look").alias("last")).where("first <> last")
    joined = kept.join(classes.select("class", "first"), F.collate(kept["look"], "UNICODE") == F.col("class"), "left")
    merged = joined.select("row", F.coalesce("first", "look").alias("canonical"))
    return merged.unionByName(turned).unionByName(plain).select("row.*", "canonical")


def snippet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field_name, domain, ord, snippet) of every non-blank snippet of locations and orgs."""
    loc = table(spark, sf_dir, "locations").select(F.lit("location").alias("field_name"), "domain", "ord", "snippet")
    both = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"{f}__snippet").alias("snippet")) for f in FIELDS])
    orgs = table(spark, sf_dir, "orgs").select("domain", "ord", F.explode(both).alias("x")).select("x.field_name", "domain", "ord", "x.snippet")
    return loc.unionByName(orgs).where(clean("snippet") != "")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows of one domain and field whose snippets look the same but differ."""
    rows = canonical_forms(snippet_rows(spark, sf_dir).where("domain is not null"))
    keyed = rows.select("field_name", "ord", F.unhex(F.md5(F.concat_ws("\n", "field_name", "domain", "canonical"))).alias("cls"), F.xxhash64("snippet").alias("form"))
    keyed = materialize(keyed, "p7-keyed")
    mixed = keyed.groupBy("cls").agg(F.min("form").alias("lo"), F.max("form").alias("hi")).where("lo <> hi").select("cls")
    members = keyed.join(mixed, "cls", "left_semi")
    a = members.select("cls", "field_name", F.col("ord").cast("long").alias("ord_a"), F.col("form").alias("fa"))
    b = members.select("cls", F.col("ord").cast("long").alias("ord_b"), F.col("form").alias("fb"))
    return a.join(b, "cls").where("fa <> fb and ord_a < ord_b").select("field_name", "ord_a", "ord_b")


def p7_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every snippet with its canonical form."""
    return canonical_forms(snippet_rows(spark, sf_dir)).select("field_name", "ord", "snippet", "canonical")
