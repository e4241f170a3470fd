"""Incremental ingestion with Structured Streaming: resumable appends, a hand-off between phases and running counts.

Every stream has a checkpoint, so a restart continues where the last finished batch ended. Sinks are idempotent: a
batch that runs again adds no key twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.sources.tables import table


def append_new(stream: DataFrame, output: str, checkpoint: str, key: str, keep: Column | None = None) -> None:
    """Runs the stream over what is there and appends the first row of each new key to the parquet ``output``.

    Rows for which ``keep`` is not true (results worth another try) are not written, so a later run meets their keys
    again. Keys that the output holds are dropped by a left-anti join; a null key is never written.
    """
    spark = stream.sparkSession

    def sink(batch: DataFrame, _: int) -> None:
        rows = batch.where(F.col(key).isNotNull())
        rows = rows.where(F.coalesce(keep, F.lit(False))) if keep is not None else rows
        first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), "ord").alias("_r")).select("_r.*")
        if _exists(spark, output):
            first = first.join(spark.read.schema(batch.schema).parquet(output).select(key), key, "left_anti").select(batch.columns)
        first.write.mode("append").parquet(output)

    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def hand_off(stream: DataFrame, state: str, checkpoint: str) -> None:
    """Runs the first phase: its rows go to the JSON lines ``state``, from which ``second_phase`` reads."""
    stream.writeStream.format("json").option("path", state).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def second_phase(spark: SparkSession, state: str, schema: str, work: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> None:
    """Reads the state's new files, applies ``work`` and appends the result; files come in any number of runs."""
    rows = spark.readStream.schema(schema).json(state)
    work(rows).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def running_counts(stream: DataFrame, at: str, by: list[str], window: str, late: str, output: str, checkpoint: str) -> None:
    """Counts by window and key that are kept between runs; rows later than ``late`` behind the newest are left out."""
    counts = stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), *by).agg(F.count("*").alias("n"))
    flat = counts.select(F.col("w.start").alias("start"), *by, "n")

    def sink(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(output)

    flat.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as a stream of its files; by a pattern, as a table may be one file or a folder."""
    pattern = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(pattern)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
