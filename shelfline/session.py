"""Session construction and the shared scratch area."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from shelfline import files

SCRATCH_SETTING = "spark.checkpoint.dir"
FREEING_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGED: list[str] = []
_local_scratch: str | None = None


def build_session(app: str = "shelfline", cores: str | int = "*", partitions: int | None = None) -> SparkSession:
    """Local session with the settings every job relies on; a cluster passes its own master and sizes."""
    count = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions or count))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SHELFLINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, because there the one
    machine is the whole cluster.
    """
    configured = spark.conf.get(SCRATCH_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SCRATCH_SETTING} to a folder every executor can reach")
    global _local_scratch
    _local_scratch = _local_scratch or tempfile.mkdtemp(prefix="shelfline-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at reliable storage, so values that depend on the physical layout
    (such as partition numbers) stay fixed when an executor is lost.
    """
    return stage_at(df, label)[0]


def stage_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As :func:`stage_table`, with the path, so that a loop can drop a copy it is done with."""
    path = scratch_path(df.sparkSession, label)
    _STAGED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage_by(df: DataFrame, label: str, *columns: str, order: str | None = None) -> DataFrame:
    """As :func:`stage_table`, in one folder for each value of ``columns``, so that a filter on them opens only its folders."""
    path = scratch_path(df.sparkSession, label)
    _STAGED.append(path)
    dealt = df.hint("rebalance", *columns)
    (dealt.sortWithinPartitions(*columns, order) if order else dealt).write.partitionBy(*columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action inside go when it ends; else they stay until the driver collects its frames."""
    before = spark.conf.get(FREEING_SETTING, None)
    spark.conf.set(FREEING_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREEING_SETTING)
        else:
            spark.conf.set(FREEING_SETTING, before)


def stage_freed(df: DataFrame, label: str, by: str | None = None, path: str | None = None) -> tuple[DataFrame, str]:
    """As :func:`stage_at`, for large steps: closely packed, and the shuffle files behind the rows go with the write.

    ``by`` deals rows over folders by its values; ``path`` adds the rows to a table staged before.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, label)
        _STAGED.append(path)
    writer = df.write.mode("append").option("compression", "zstd")
    with freeing_shuffles(spark):
        (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_staged(spark: SparkSession, path: str) -> None:
    """Delete one staged table that no later step reads."""
    if path in _STAGED:
        _STAGED.remove(path)
    files.delete(spark, path)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this process has staged. Call it once their results are written or read."""
    released = 0
    while _STAGED:
        released += bool(files.delete(spark, _STAGED.pop()))
    return released


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over all shuffle partitions for compute-heavy kernels.

    The explicit number keeps the adaptive planner from merging partitions that are small in
    bytes but long in run time.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
