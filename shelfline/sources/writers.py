"""Sinks: partitioned appends, keyed upserts, exports and the audit table."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.ordered import newest_per_key
from shelfline.session import stage_table
from shelfline.sources import commits

AUDIT_SCHEMA = (
    "run_id string, job string, event string, at timestamp, inputs array<string>, outputs array<string>, "
    "row_count long, feature_count int, features array<string>, quality_score double, message string"
)


def _layout(df: DataFrame, *columns: str) -> DataFrame:
    """Bring equal partition values together before a write.

    Without it every task writes a file per value it holds. The hint lets the adaptive planner
    split a hot value over several tasks and merge small ones.
    """
    return df.hint("rebalance", *columns)


def by_month(df: DataFrame, time: str = "timestamp", finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows with ``year`` and ``month`` of ``time``, those of a month together.

    ``finish`` works out columns row by row behind the shuffle and the sort, so that both move only the
    columns it starts from; it keeps ``year`` and ``month``.
    """
    laid = _layout(df.withColumns({"year": F.year(time), "month": F.month(time)}), "year", "month")
    return finish(laid.sortWithinPartitions("year", "month")) if finish else laid


def append_by_month(df: DataFrame, path: str, time: str = "timestamp", finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append, partitioned by year and month of ``time``; see :func:`by_month` for ``finish``."""
    by_month(df, time, finish).write.mode("append").option("compression", "zstd").partitionBy("year", "month").parquet(path)


def add_months(df: DataFrame, path: str, time: str = "timestamp", check=None) -> None:
    """Add rows to a table with commits, partitioned by year and month of ``time``; rows without a time are in year 0, month 0."""
    dated = df.withColumns({"year": F.coalesce(F.year(time), F.lit(0)), "month": F.coalesce(F.month(time), F.lit(0))})
    commits.write(dated, path, ["year", "month"], check=check)


def append_by_column(df: DataFrame, path: str, column: str) -> None:
    _layout(df, column).write.mode("append").partitionBy(column).parquet(path)


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Attach counters that the next action fills: no second scan."""
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    return df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"source has duplicate keys {list(keys)}")


def upsert(
    source: DataFrame, path: str, keys: Sequence[str], partition: str, newest: Sequence[Column] | None = None
) -> None:
    """Insert new keys and replace known ones in a table with commits (see ``sources.commits``).

    ``partition`` must be a key or a function of one, so that a key never changes partition.
    Only the partitions the source touches are read and written anew, once, beside the old ones; a
    write that breaks before its commit leaves the table as it was. With ``newest`` a known row is
    replaced only if the new one comes first in that order.
    """
    spark = source.sparkSession
    source = stage_table(source, "upsert-source")
    check_unique(source, keys)
    commit = commits.last_commit(spark, path)
    touched = source.select(partition).distinct()
    if commit is None:
        merged = source
    else:
        target = commits.read(spark, path, commit, only=touched)
        if newest:
            merged = newest_per_key(target.unionByName(source, allowMissingColumns=True), keys, newest)
        else:
            merged = target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)
    commits.write(merged, path, [partition], replaces=touched)


def upsert_customer_features(df: DataFrame, path: str) -> None:
    upsert(df, path, ["customer_id", "snapshot_date"], "snapshot_date")


def upsert_sku_features(df: DataFrame, path: str) -> None:
    """Keyed by SKU and day; partitioned by month because SKUs are too many for folders."""
    upsert(df.withColumn("sales_month", F.date_format("date", "yyyy-MM")), path, ["product_id", "date"], "sales_month")


def audit_row(
    spark: SparkSession, path: str, job: str, event: str, run_id: str, inputs: Sequence[str] = (),
    outputs: Sequence[str] = (), row_count: int | None = None, features: Sequence[str] = (),
    quality_score: float | None = None, message: str | None = None,
) -> None:
    """Append one audit record; counts come from the run itself."""
    row = (
        run_id, job, event, datetime.datetime.now(datetime.timezone.utc), list(inputs), list(outputs), row_count,
        len(features), list(features), quality_score, message,
    )
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV folder with header; the first header name starts with a byte-order mark."""
    first, *rest = df.columns
    df.select(F.col(first).alias("﻿" + first), *rest).write.option("header", True).csv(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.json(path)
