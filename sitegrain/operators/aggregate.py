"""Counts, shares, containment and classifications over groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def share_of_total(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, share): the count of each key and its share of all rows."""
    total = max(1, rows.count())
    return rows.groupBy(key).agg(F.count("*").alias("n")).withColumn("share", F.round(F.col("n") / total, 6))


def graded_counts(results: DataFrame, by: list[str], match: str = "match") -> DataFrame:
    """(by, hits, misses, skips, scored): exact, soft and null matches are hits; skips are not scored."""
    m = F.col(match)
    hit, miss = F.count_if(m.isin("exact", "soft", "null_match")), F.count_if(m == "miss")
    return results.groupBy(*by).agg(hit.alias("hits"), miss.alias("misses"), F.count_if(m == "skip").alias("skips"), (hit + miss).alias("scored"))


def percent(hits: Column, scored: Column) -> Column:
    """The whole percentage with its sign, halves to the even number; 'n/a' where nothing is scored."""
    return F.when(scored == 0, "n/a").otherwise(F.concat(F.bround(hits * 100 / scored, 0).cast("int").cast("string"), F.lit("%")))


def having_all(rows: DataFrame, key: str, value: str, required: list[str]) -> DataFrame:
    """The keys whose values hold every required one."""
    wanted = rows.where(F.col(value).isin(*required)).groupBy(key).agg(F.count_distinct(value).alias("_n"))
    return wanted.where(F.col("_n") == len(set(required))).select(key)


def children(rows: DataFrame, parent: list[str], child: str, least: int = 2) -> DataFrame:
    """(parent, n_children) of the parents with ``least`` distinct children."""
    return rows.groupBy(*parent).agg(F.count_distinct(child).alias("n_children")).where(F.col("n_children") >= least)


def presence(entities: DataFrame, facts: DataFrame, key: str, active: Column) -> DataFrame:
    """Each entity with (status, confidence): active and high with an active fact, inactive and medium with any fact,
    else unknown and low; a blank key is not_found for both.
    """
    seen = facts.groupBy(key).agg(F.max(active.cast("int")).alias("_active"))
    blank = F.trim(F.coalesce(F.col(key), F.lit(""))) == ""
    out = entities.join(seen, key, "left")
    grade = lambda *v: F.when(blank, v[0]).when(F.col("_active") == 1, v[1]).when(F.col("_active") == 0, v[2]).otherwise(v[3])
    return out.select(*entities.columns, grade("not_found", "active", "inactive", "unknown").alias("status"), grade("not_found", "high", "medium", "low").alias("confidence"))


def delta(before: DataFrame, after: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key, n_before, n_after, change, kind): the counts of both sides, a missing one as 0; same, gained or lost."""
    both = before.select(key, F.col(n).alias("n_before")).join(after.select(key, F.col(n).alias("n_after")), key, "full")
    both = both.na.fill(0, ["n_before", "n_after"]).withColumn("change", F.col("n_after") - F.col("n_before"))
    return both.withColumn("kind", F.when(F.col("change") == 0, "same").when(F.col("change") > 0, "gained").otherwise("lost"))


def first_bucket(buckets: list[tuple[str, Column]], default: str) -> Column:
    """The name of the first bucket whose condition holds."""
    out = F.lit(default)
    for name, condition in reversed(buckets):
        out = F.when(condition, name).otherwise(out)
    return out
