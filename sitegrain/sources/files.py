"""Text sources: CSV with and without header, JSON lines, plain lists, domain lists, sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitegrain.functions.text import col


def read_csv(spark: SparkSession, path: str, header: bool = True, columns: list[str] | None = None) -> DataFrame:
    """A CSV file as strings; missing values are ''. Quotes are doubled and values may span lines. Without a header the
    columns are ``columns``, or c0, c1 and so on.
    """
    rows = spark.read.csv(path, header=header, multiLine=True, quote='"', escape='"', inferSchema=False)
    names = rows.columns if header else columns or [f"c{i}" for i in range(len(rows.columns))]
    return rows.toDF(*names).na.fill("")


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object a line under a fixed schema; keys that a line lacks are null, a malformed line is all null."""
    return spark.read.schema(schema).json(path)


def read_list(spark: SparkSession, path: str, name: str = "domain") -> DataFrame:
    """One value a line; blank lines, comments behind # and a header line of the column's name are left out."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name).rlike("^[^#]") & (F.col(name) != name))


def domain_column(rows: DataFrame) -> DataFrame:
    """The rows' ``domain``: that column where there is one, else the first."""
    return rows.select(F.col("domain" if "domain" in rows.columns else rows.columns[0]).alias("domain"))


def clean_domains(rows: DataFrame, ord_: str = "ord") -> DataFrame:
    """The distinct valid domains in lower case without scheme, www. and slashes, each at its first place."""
    d = F.regexp_replace(F.regexp_replace(F.lower(F.trim("domain")), r"https?://|www\.", ""), r"^/+|/+$", "")
    kept = rows.select(d.alias("domain"), ord_).where(F.contains("domain", F.lit(".")) & ~F.contains("domain", F.lit(" ")))
    return kept.groupBy("domain").agg(F.min(ord_).alias(ord_))


def sitemap_entries(rows: DataFrame, xml: str) -> DataFrame:
    """One row for each location of the sitemap text, trimmed."""
    return rows.withColumn("loc", F.explode(F.regexp_extract_all(F.col(xml), F.lit(r"(?is)<loc>\s*([^<\s]+)\s*</loc>"), 1)))


def robots_sitemaps(text: Column | str) -> Column:
    """The sitemap addresses that a robots file names."""
    return F.regexp_extract_all(F.coalesce(col(text), F.lit("")), F.lit(r"(?i)sitemap:\s*(\S+)"), 1)


def prune(url: Column | str, keep: str, skip: str) -> Column:
    """True for a sub-sitemap that is read: a keep signal overrides a skip signal, without any it is read."""
    low = F.lower(col(url))
    return low.rlike(keep) | ~low.rlike(skip)


def processed_keys(spark: SparkSession, path: str, key: str = "domain") -> DataFrame:
    """The distinct keys that an output already holds; none where there is no output yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], f"{key} string")
    return read_csv(spark, path).where(F.col(key) != "").select(key).distinct()
