"""From pairs of groups to pairs of rows, without ever pairing the equal copies of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_pairs(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(ord_a < ord_b): rows of paired groups, and of one group, whose stored values differ.

    ``members``: grp, raw (number of the stored value), ord; ``pairs``: ga, gb with ga <> gb. The values are paired
    first, rows are joined to value pairs only, so any number of copies of one value costs nothing among themselves.
    """
    values = members.select("grp", "raw").distinct()
    mixed = values.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select(F.col("grp").alias("ga"), F.col("grp").alias("gb"))
    left, right = values.toDF("ga", "ra"), values.toDF("gb", "rb")
    met = pairs.unionByName(mixed).join(left, "ga").join(right, "gb").where("ra <> rb and (ga <> gb or ra < rb)")
    a, b = members.select(F.col("grp").alias("ga"), F.col("raw").alias("ra"), F.col("ord").alias("oa")), members.select(F.col("grp").alias("gb"), F.col("raw").alias("rb"), F.col("ord").alias("ob"))
    out = met.join(a, ["ga", "ra"]).join(b, ["gb", "rb"])
    return out.select(F.least("oa", "ob").alias("ord_a"), F.greatest("oa", "ob").alias("ord_b"))
