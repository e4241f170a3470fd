"""Sinks: CSV, JSON lines, replacement of a master, batches for sheets, keyed caches and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.operators.joins import numbered


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, mode: str = "error") -> None:
    """The columns (further ones are left out) as CSV with a header in each part; nulls are empty, spaces stay."""
    rows = rows.select(*columns) if columns else rows
    rows.write.mode(mode).csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def append_json_lines(rows: DataFrame, path: str) -> None:
    """One JSON object a row behind what is there; null fields are left out."""
    rows.write.mode("append").json(path)


def replace_master(rows: DataFrame, path: str, backup: str) -> None:
    """The parquet master replaced by ``rows``, which may be read from it: they are written beside it, the master moves
    to ``backup`` and the new table to its place. A failure before the first move leaves the master untouched.
    """
    spark: SparkSession = rows.sparkSession
    fresh = f"{path.rstrip('/')}.new"
    rows.write.mode("overwrite").parquet(fresh)
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, backup, fresh)]
    files = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(paths[0]):
        files.delete(paths[1], True)
        if not files.rename(paths[0], paths[1]):
            raise OSError(f"{path} could not be moved to {backup}")
    if not files.rename(paths[2], paths[0]):
        raise OSError(f"{fresh} could not be moved to {path}")


def column_letter(number: Column) -> Column:
    """The letters of a sheet's column, 1 is A and 27 is AA, up to ZZZ."""
    n = number - 1
    third, second = F.floor((n - 26) / 676), F.floor(n / 26)

    def letter(i: Column) -> Column:
        return F.chr((F.lit(65) + i).cast("int"))

    two = F.concat(letter(F.pmod(second - 1, F.lit(26))), letter(F.pmod(n, F.lit(26))))
    return F.when(n < 26, letter(n)).when(n < 702, two).otherwise(F.concat(letter(F.pmod(third - 1, F.lit(26))), two))


def sheet_batches(rows: DataFrame, ord_: str = "ord", size: int = 1000, first_row: int = 2) -> DataFrame:
    """The rows with their sheet row and batch, and the range that the batch fills."""
    out = numbered(rows, ord_, "row_no").withColumn("batch", F.floor((F.col("row_no") - 1) / size).cast("long"))
    low = F.col("batch") * size + first_row
    return out.withColumn("cells", F.concat(F.lit("A"), low.cast("string"), F.lit(":"), column_letter(F.lit(len(rows.columns))), (low + size - 1).cast("string")))


def invalidate(cache: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The cache without the given keys."""
    return cache.join(keys.select(key).distinct(), key, "left_anti")


def upsert(cache: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The cache with the new rows in place of those of their keys."""
    return invalidate(cache, new, key).unionByName(new)


def markdown_table(rows: DataFrame, limit: int = 1000) -> str:
    """A report table of aggregated rows, ``limit`` of them at most."""
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows.limit(limit).collect()])
