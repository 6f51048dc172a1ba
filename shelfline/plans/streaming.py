"""Streaming extension queries over the events table, checked against batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.plans.registry import query
from shelfline.plans.views import Tables
from shelfline.session import scratch_path
from shelfline.sources import readers
from shelfline.streaming import jobs


def event_stream(t: Tables, files_per_batch: int = 2) -> DataFrame:
    """The events as several landed files in time order, read as a stream."""
    path = scratch_path(t.spark, "landed-events")
    t.events.repartitionByRange(4, "ts").write.parquet(path)
    return jobs.file_stream(t.spark, path, t.events.schema, files_per_batch)


@query(
    "ext_stream_bronze",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, 'ECOMMERCE' AS source_system FROM events GROUP BY 1, 2",
)
def ext_stream_bronze(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream-bronze")
    jobs.stream_append(event_stream(t), path, scratch_path(t.spark, "checkpoint"), "ECOMMERCE")
    return t.spark.read.parquet(path).groupBy("day", "event_type", "source_system").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ext_stream_upsert",
    """SELECT user_id, CAST(ts AS DATE) AS day, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
)
def ext_stream_upsert(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream-upsert")
    rows = event_stream(t).select("user_id", F.to_date("ts").alias("day"), "event_id", "ts", "value")
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    jobs.stream_upsert(rows, path, scratch_path(t.spark, "checkpoint"), ["user_id", "day"], "day", newest)
    return readers.read_table(t.spark, path).select("user_id", "day", "event_id", "ts", "value")


@query(
    "ext_event_windows",
    """WITH w AS (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)
SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, n, total FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE""",
)
def ext_event_windows(t: Tables) -> DataFrame:
    """Hourly counts of every window that the watermark has closed."""
    path = scratch_path(t.spark, "stream-windows")
    jobs.stream_windows(event_stream(t), path, scratch_path(t.spark, "checkpoint"))
    out = t.spark.read.parquet(path)
    return out.select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "event_type", "n",
        F.col("total").cast("double").alias("total"),
    )


@query(
    "ext_event_sessions",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER o < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g),
r AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, sid)
SELECT * FROM r WHERE "end" <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 MINUTE""",
)
def ext_event_sessions(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "stream-sessions")
    jobs.stream_sessions(event_stream(t), path, scratch_path(t.spark, "checkpoint"), "user_id")
    out = t.spark.read.parquet(path)
    return out.select(
        F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "user_id", "n"
    )
