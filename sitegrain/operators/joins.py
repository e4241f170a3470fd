"""Keyed operators on ordered tables: resume, lookups, replacements and best matches.

Tables carry their order in a column (``ord``); every result that has an order keeps it as data. Keys are compared as
they are given: null keys meet nothing, callers make blanks alike first (``clean``). Duplicate keys are kept unless
the operator says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def todo(rows: DataFrame, done: DataFrame, key: str, ord_: str = "ord", limit: int | None = None) -> DataFrame:
    """The rows whose key is not done yet, the first ``limit`` by order. A null key is never done."""
    left = rows.join(done.select(key).distinct(), key, "left_anti").select(rows.columns)
    return left if limit is None else left.orderBy(ord_).limit(limit)


def last_per_key(rows: DataFrame, key: list[str], ord_: str = "ord") -> DataFrame:
    """The last row of each key with ``first_ord``, the key's first place. One row a key leaves each map task."""
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rows.columns), ord_).alias("_r"), F.min(ord_).alias("first_ord"))
    return best.select("_r.*", "first_ord")


def first_per_key(rows: DataFrame, key: list[str], ord_: str = "ord") -> DataFrame:
    """The first row of each key."""
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), ord_).alias("_r")).select("_r.*")


def replace_every(master: DataFrame, new: DataFrame, key: str, ord_: str = "ord") -> DataFrame:
    """The master with every row of a key in ``new`` replaced by its last new row, in place; rows of unknown keys follow.

    Both tables must have the same columns, or a ValueError names the difference. ``part`` is 0 for master places and 1
    for appended rows, ``place`` the order within it.
    """
    if set(master.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(master.columns) ^ set(new.columns))}")
    values = [c for c in master.columns if c not in (key, ord_)]
    last = last_per_key(new.where(F.col(key).isNotNull()), [key], ord_)
    packed = last.select(key, F.struct(*values).alias("_new"), F.col(ord_).alias("_place"))
    kept = master.join(packed.drop("_place"), key, "left").select(key, *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values], F.lit(0).alias("part"), F.col(ord_).alias("place"))
    added = packed.join(master.select(key).distinct(), key, "left_anti").select(key, *[F.col(f"_new.{c}").alias(c) for c in values], F.lit(1).alias("part"), F.col("_place").alias("place"))
    return kept.unionByName(added)


def replace_first(master: DataFrame, new: DataFrame, key: str, ord_: str = "ord") -> DataFrame:
    """The master with the first row of each key in ``new`` replaced; later duplicates and unknown keys stay as they are.

    Columns that ``new`` lacks keep the master's value.
    """
    values = [c for c in master.columns if c not in (key, ord_)]
    given = [c for c in values if c in new.columns]
    last = last_per_key(new.where(F.col(key).isNotNull()), [key], ord_).select(key, F.struct(*given).alias("_new"))
    firsts = master.groupBy(key).agg(F.min(ord_).alias("_first"))
    joined = master.join(firsts, key, "left").join(last, key, "left")
    hit = F.col("_new").isNotNull() & (F.col(ord_) == F.col("_first"))
    return joined.select(key, ord_, *[F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in values])


def replace_partitions(master: DataFrame, new: DataFrame, key: Column) -> DataFrame:
    """The master without the rows of the keys that ``new`` covers, and all rows of ``new`` after them (``part`` 1)."""
    covered = new.select(key.alias("_k")).distinct()
    kept = master.withColumn("_k", key).join(covered, "_k", "left_anti").drop("_k")
    return kept.withColumn("part", F.lit(0)).unionByName(new.withColumn("part", F.lit(1)), allowMissingColumns=True)


def lookup(rows: DataFrame, table: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """The rows with looked-up columns; a row without a match, or with a null, has the given default.

    The first column of a key with several rows is not defined by order, so ``table`` must be unique by key.
    """
    joined = rows.join(table.select(key, *values), key, "left")
    return joined.select(*rows.columns, *[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in values.items()])


def ranges(rows: DataFrame, ord_: str = "ord", parts: int = 256) -> DataFrame:
    """The rows with ``_range``: their order cut into ``parts`` equal ranges. The ends of the order are read first."""
    low, high = rows.agg(F.min(ord_), F.max(ord_)).first()  # one row
    if low is None:
        return rows.withColumn("_range", F.lit(0).cast("long"))
    return rows.withColumn("_range", F.floor((F.col(ord_) - low) * parts / (high - low + 1)).cast("long"))


def running(rows: DataFrame, per: list[str], values: dict[str, Column], ord_: str = "ord", own: bool = True, then: list[str] | None = None) -> DataFrame:
    """The rows with running sums of the values in each group by order, of the rows before alone with ``own`` False.

    Sums are taken within ranges of the order and the sums of the ranges before are added, so a group that holds most
    rows is sorted in pieces and not in one task; a null counts as 0. ``ord_`` must be a number; ties go by ``then``.
    """
    given = {f"_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(values.values())}
    cut = ranges(rows.withColumns(given), ord_)
    sums = cut.groupBy(*per, "_range").agg(*[F.sum(v).alias(f"{v}s") for v in given])
    over = Window.partitionBy(*per).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # 256 rows a group at most
    before = sums.select(*per, "_range", *[F.coalesce(F.sum(f"{v}s").over(over), F.lit(0)).alias(f"{v}b") for v in given])
    same = [cut[k].eqNullSafe(before[k]) for k in [*per, "_range"]]
    joined = cut.join(before, [*per, "_range"]) if not per else cut.join(before, same).select(cut["*"], *[before[f"{v}b"] for v in given])
    within = Window.partitionBy(*per, "_range").orderBy(ord_, *(then or [])).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    out = {n: F.coalesce(F.sum(v).over(within), F.lit(0)) + F.col(f"{v}b") for n, v in zip(values, given)}
    return joined.select(*rows.columns, *[c.alias(n) for n, c in out.items()])


def numbered(rows: DataFrame, ord_: str = "ord", name: str = "request_id", per: list[str] | None = None) -> DataFrame:
    """The rows with their number by order, from 1; with ``per`` the numbers start again in each group."""
    return running(rows, per or [], {name: F.lit(1).cast("long")}, ord_)


def best_match(rows: DataFrame, candidates: DataFrame, by: str, score: list[Column], where: Column | None = None, ord_: str = "ord", tie: str = "c_ord") -> DataFrame:
    """Each row with its best candidate of the same ``by``: the greatest ``score``, then the first candidate.

    Rows without an accepted candidate keep nulls. ``candidates`` have names of their own but for ``by``. The best is
    kept by a partial aggregation, so a group of many candidates never stands in one task.
    """
    names = [c for c in candidates.columns if c != by]
    met = rows.join(candidates, by)
    if where is not None:
        met = met.where(where)
    best = met.groupBy(ord_).agg(F.max_by(F.struct(*names), F.struct(*score, -F.col(tie))).alias("_c"))
    return rows.join(best, ord_, "left").select(*rows.columns, *[F.col(f"_c.{c}").alias(c) for c in names])


def shared_letters(a: Column, b: Column) -> Column:
    """The number of distinct characters that both texts have."""
    return F.size(F.array_intersect(F.filter(F.split(a, ""), lambda x: x != ""), F.filter(F.split(b, ""), lambda x: x != "")))


def first_of(*sources: tuple[Column, Column]) -> Column:
    """The value of the first (condition, value) that holds, else null: a chain of fallbacks in one expression."""
    out = F.lit(None)
    for condition, value in reversed(sources):
        out = F.when(condition, value).otherwise(out)
    return out
