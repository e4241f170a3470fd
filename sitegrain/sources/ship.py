"""The engine's own code on the executors: Python functions are sent by name, so the workers must be able to import it."""

from __future__ import annotations

import shutil
import tempfile
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers, once a session: Spark's own file service brings the archive to every executor."""
    context = getattr(spark, "_sc", None)
    key = context.applicationId if context is not None else str(id(spark))
    if key in _SHIPPED:
        return
    archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="sitegrain-code-")) / PACKAGE.name), "zip", PACKAGE.parent, PACKAGE.name)
    if context is not None:
        context.addPyFile(archive)
    else:
        spark.addArtifact(archive, pyfile=True)
    _SHIPPED.add(key)


def shipping(query):
    """The query with the package sent before it runs."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
