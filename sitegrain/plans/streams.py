"""Queries that run as streams over the tables' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.plans.registry import query
from sitegrain.sources.tables import scratch_path as _path
from sitegrain.streaming import resume as st


@query("SELECT domain, min(ord) AS ord FROM orgs WHERE domain IS NOT NULL AND fetch_status IS DISTINCT FROM 'blocked' AND fetch_status IS NOT NULL GROUP BY domain")
def stream_resumed(spark: SparkSession, d: str) -> DataFrame:
    """St1, St2, X2: rows appended as they come, without those worth another try; a second run adds nothing."""
    output = _path(spark, "stream-out")
    for run in range(2):
        rows = st.table_stream(spark, d, "orgs").select("domain", "ord", "fetch_status")
        st.append_new(rows, output, _path(spark, f"stream-check-{run}"), "domain", F.col("fetch_status") != "blocked")
    return spark.read.parquet(output).select("domain", "ord")


@query("SELECT ord, upper(status) AS status FROM classified_rows WHERE status IS NOT NULL")
def stream_two_phases(spark: SparkSession, d: str) -> DataFrame:
    """St3, X6, X7: a first phase hands its rows to a second one through a JSON lines state."""
    state, output = _path(spark, "stream-state"), _path(spark, "stream-final")
    st.hand_off(st.table_stream(spark, d, "classified_rows").select("ord", "status").where("status is not null"), state, _path(spark, "check-a"))
    st.second_phase(spark, state, "ord long, status string", lambda rows: rows.select("ord", F.upper("status").alias("status")), output, _path(spark, "check-b"))
    return spark.read.parquet(output)


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    """St5: counters by day and kind that are kept in the stream's state."""
    output = _path(spark, "stream-counts")
    st.running_counts(st.table_stream(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type"), "ts", ["event_type"], "1 day", "2 days", output, _path(spark, "check-c"))
    return spark.read.parquet(output)
