"""Streaming extensions of the landing path. They are additions: the batch jobs do not need them.

Every job runs with ``availableNow``: it drains what has landed, in bounded batches, and stops.
Offsets and state live in a checkpoint in shared storage, so a restarted job goes on where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.frames import enrich_metadata
from shelfline.operators.ordered import newest_per_key
from shelfline.sources.writers import upsert


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_append(stream: DataFrame, path: str, checkpoint: str, source_system: str, time: str = "ts") -> None:
    """Append landed rows, stamped and partitioned by day."""
    stamped = enrich_metadata(stream, source_system).withColumn("day", F.to_date(time))
    writer = stamped.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.option("path", path).partitionBy("day").trigger(availableNow=True).start().awaitTermination()


def stream_upsert(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition: str, newest: Sequence[Column]
) -> None:
    """Keep the newest row per key in a table. A batch that runs twice leaves the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = newest_per_key(batch, keys, newest)
        if not rows.isEmpty():
            upsert(rows, path, keys, partition, newest)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def _drain(df: DataFrame, path: str, checkpoint: str) -> None:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer.option("path", path).trigger(availableNow=True).start().awaitTermination()


def stream_windows(stream: DataFrame, path: str, checkpoint: str, time: str = "ts", size: str = "1 hour", late: str = "10 minutes") -> None:
    """Counts and sums per event type and window, written once the watermark has passed the window."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    counts = timed.groupBy(F.window(time, size).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")
    )
    _drain(counts.select("w.start", "w.end", "event_type", "n", "total"), path, checkpoint)


def stream_sessions(stream: DataFrame, path: str, checkpoint: str, key: str, time: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> None:
    """Sessions per key that end after ``gap`` without events."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    sessions = timed.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    _drain(sessions.select("w.start", "w.end", key, "n"), path, checkpoint)
