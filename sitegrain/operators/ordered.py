"""Operators that depend on the order of rows: running figures, early stops, first-k, samples and batches.

Running figures are summed in ranges of the order (``joins.running``), so a group may hold most of the rows. The first k
of a group are cut down in each map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitegrain.operators.joins import running


def rolling_rate(rows: DataFrame, per: list[str], at: str, ord_: str, size: int = 20) -> DataFrame:
    """With ``rate``: of the last ``size`` rows of the group, rows a second; 0 for the first row.

    Rows are numbered in ranges of time; the first row of a frame is then met by its number, so no group is sorted whole.
    """
    timed = rows.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp")))
    n = running(timed, per, {"_no": F.lit(1).cast("long")}, "_at", then=[ord_])
    frames = n.select(*[F.col(p).alias(f"_f{i}") for i, p in enumerate(per)], (F.col("_no") + size - 1).alias("_fn"), F.col("_at").alias("_start"))
    firsts = timed.groupBy(*[F.col(p).alias(f"_g{i}") for i, p in enumerate(per)]).agg(F.min("_at").alias("_least"))
    joined = n
    for other, mark, more in ((frames, "_f", [F.col("_no") == F.col("_fn")]), (firsts, "_g", [])):
        on = [F.col(p).eqNullSafe(F.col(f"{mark}{i}")) for i, p in enumerate(per)] + more
        joined = joined.join(other, on, "left")
    span = F.greatest((F.col("_at") - F.coalesce("_start", "_least")) / 1e6, F.lit(0.001))
    return joined.select(*rows.columns, F.round((F.least("_no", F.lit(size)) - 1) / span, 6).alias("rate"))


def until_cap(rows: DataFrame, per: list[str], cost: str, cap: float, ord_: str = "ord") -> DataFrame:
    """The rows admitted while what the earlier rows of the group cost stays below ``cap``; a null cost is 0."""
    return running(rows, per, {"_spent": F.col(cost).cast("double")}, ord_, own=False).where(F.col("_spent") < cap).drop("_spent")


def running_counts(rows: DataFrame, per: list[str], flags: dict[str, Column], every: int, ord_: str = "ord") -> DataFrame:
    """Every ``every``-th row of the group with its number and the counts of the flags so far."""
    counts = {"row_no": F.lit(1).cast("long"), **{n: F.when(f, 1).otherwise(0).cast("long") for n, f in flags.items()}}
    return running(rows, per, counts, ord_).where(F.col("row_no") % every == 0).select(*per, ord_, *counts)


def early_stop(rows: DataFrame, per: list[str], kind: str, found: str, streak: int = 3, ord_: str = "ord") -> DataFrame:
    """The rows up to the one at which ``streak`` pages in a row found nothing after a hub had found something.

    Rows of another kind than 'page' do not count as empty; any row that found something starts the count again.
    """
    hit = F.col(found) > 0
    marked = running(rows, per, {"_run": hit.cast("long"), "_hub": (hit & (F.col(kind) == "hub")).cast("long")}, ord_)
    counted = running(marked, [*per, "_run"], {"_empty": (~hit & (F.col(kind) == "page")).cast("long")}, ord_)
    stops = counted.where((F.col("_empty") >= streak) & (F.col("_hub") > 0)).groupBy(*per).agg(F.min(ord_).alias("_end"))
    return counted.join(stops, per, "left").where(F.col("_end").isNull() | (F.col(ord_) <= F.col("_end"))).select(rows.columns)


def first_k(rows: DataFrame, per: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with ``rank``. Spark keeps k rows of a group in each map task before the shuffle."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("rank") <= k)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def sample_per_group(rows: DataFrame, per: list[str], id_: str, k: int, seed: int = 7) -> DataFrame:
    """``k`` rows of each group drawn by the MD5 of id and seed, the same on every engine and run."""
    return first_k(rows, per, [F.md5(F.concat(F.col(id_).cast("string"), F.lit(f":{seed}"))), F.col(id_)], k).drop("rank")


def batches(numbered_rows: DataFrame, number: str, size: int) -> DataFrame:
    """With ``batch``: rows numbered from 1 in batches of ``size``, from 0."""
    return numbered_rows.withColumn("batch", F.floor((F.col(number) - 1) / size).cast("long"))


def with_fallback(rows: DataFrame, per: list[str], conditions: list[Column], k_last: int, ord_: str = "ord") -> DataFrame:
    """Of each group the rows of the first condition that any of its rows meets; where none does, its first ``k_last``."""
    level = F.lit(len(conditions))
    for i, c in reversed(list(enumerate(conditions))):
        level = F.when(c, i).otherwise(level)
    marked = rows.withColumn("_level", level)
    best = marked.groupBy(*per).agg(F.min("_level").alias("_best"))
    kept = marked.join(best, per).where(F.col("_level") == F.col("_best"))
    last = F.col("_best") == len(conditions)
    return kept.where(~last).select(rows.columns).unionByName(first_k(kept.where(last), per, [F.col(ord_)], k_last).select(rows.columns))
