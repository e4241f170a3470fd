"""Readers of the parquet tables, and durable intermediates.

``materialize`` is the only way the library cuts lineage: it writes a table into the folder that all
executors share (``spark.checkpoint.dir``), so the loss of an executor costs no finished work.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the session. Where none is named, a session within one JVM makes its own; a cluster raises."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _OWN:
        _OWN["dir"] = tempfile.mkdtemp(prefix="sitegrain-")
    return _OWN["dir"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the session ends."""
    folder = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        target = jvm.org.apache.hadoop.fs.Path(folder)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(target)
        files.deleteOnExit(target)
    return f"{folder}/data"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
