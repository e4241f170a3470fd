"""Distinct and group collapse by keys, order and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrain.functions.addresses import city_key, norm_street, street_signature
from sitegrain.functions.text import alnum_key, clean, is_blank, lower_trim


def distinct_first(rows: DataFrame, key: list[Column], ord_: str = "ord") -> DataFrame:
    """The first row of each key. Null parts of a key are alike."""
    keyed = rows.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(key)]).agg(F.min_by(F.struct(*rows.columns), ord_).alias("_r"))
    return keyed.select("_r.*")


def completeness(*columns: str) -> Column:
    """How many of the columns are not blank."""
    return sum((F.when(is_blank(c), 0).otherwise(1) for c in columns), F.lit(0))


def most_complete(rows: DataFrame, key: list[Column], filled: list[str], ord_: str = "ord") -> DataFrame:
    """One row a key, the most complete and of equals the first, with ``first_ord``, the place of the group's first row."""
    score = completeness(*filled)
    groups = rows.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(key)])
    best = groups.agg(F.max_by(F.struct(*rows.columns), F.struct(score, -F.col(ord_))).alias("_r"), F.min(ord_).alias("first_ord"), F.count("*").alias("n_rows"))
    return best.select("_r.*", "first_ord", "n_rows")


def street_key() -> list[Column]:
    """Domain, street with its unit, city and state."""
    return [lower_trim("domain"), norm_street("address_street"), city_key("address_city"), F.upper(clean("address_state"))]


def signature_key() -> list[Column]:
    """Domain, state, city, house number and street word."""
    s = street_signature("address_street")
    return [lower_trim("domain"), alnum_key("address_state"), city_key("address_city"), s["number"], s["word"]]


def dedupe_places(rows: DataFrame, keep_empty: bool = False, ord_: str = "ord") -> DataFrame:
    """The places of each domain once.

    A row without a street goes where a row of its domain with a street has its postal code or city; a row without
    street, code and city goes too, or the first of them stays with ``keep_empty``. Of the others the first row stays
    for each code (city where blank), house number and street word; rows without a street are one kind of their own.
    """
    zip_, city, blank = clean("address_zip"), city_key("address_city"), is_blank("address_street")
    marked = rows.withColumns({"_zip": zip_, "_city": city, "_bare": blank, "_dom": lower_trim("domain")})
    with_street = marked.where("not _bare")
    zips = with_street.where("_zip <> ''").select("_dom", "_zip").distinct()
    cities = with_street.where("_city <> ''").select("_dom", "_city").distinct()
    bare = marked.where("_bare").join(zips, ["_dom", "_zip"], "left_anti").join(cities, ["_dom", "_city"], "left_anti")
    if not keep_empty:
        bare = bare.where("_zip <> '' or _city <> ''")
    left = with_street.unionByName(bare)
    s = street_signature("address_street")
    key = [F.col("_dom"), F.col("_bare"), F.when(F.col("_bare"), F.concat_ws("|", "_zip", "_city")).otherwise(F.when(F.col("_zip") != "", F.col("_zip")).otherwise(F.col("_city"))), s["number"], s["word"]]
    return distinct_first(left, key, ord_).select(rows.columns)


def dedupe_unless_blank(rows: DataFrame, columns: list[str], ord_: str = "ord") -> DataFrame:
    """The first row of each combination of the columns (trimmed, lower case); rows blank in all of them all stay."""
    parts = [lower_trim(c) for c in columns]
    blank = F.concat(*parts) == ""
    return distinct_first(rows, [*parts, F.when(blank, F.col(ord_))], ord_)


def first_success(attempts: DataFrame, key: list[str], order: Column, ok: Column) -> DataFrame:
    """One row a key: its first successful attempt, or its last attempt where none succeeded; ``succeeded`` says which."""
    row = F.struct(*attempts.columns)
    best = attempts.groupBy(*key).agg(F.min_by(F.when(ok, row), F.when(ok, order)).alias("_ok"), F.max_by(row, order).alias("_last"))
    return best.select(F.coalesce("_ok", "_last").alias("_r"), F.col("_ok").isNotNull().alias("succeeded")).select("_r.*", "succeeded")
