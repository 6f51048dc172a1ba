"""Partitioned tables with commits: readers see the files of the last commit and nothing else.

    table/data/write_id=<id>/<partition>=<value>/...   rows of one write, never changed afterwards
    table/live/<id>                                    (partition, write_id, n_rows) of that commit
    table/commits/<number>.json                        schema, partition columns, row count, live folder

A write adds a folder of rows and one of live partitions; both are invisible until the commit file
exists. That file is created, never replaced: of two writers with the same number one fails. A write
that breaks leaves the old state, and its folders go with the next :func:`vacuum`. Partition values
and row counts stay in tables; the driver sees one small commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline import files

WRITE = "write_id"


@dataclass(frozen=True)
class Commit:
    number: int
    schema: T.StructType
    partition: tuple[str, ...]
    live: str
    n_rows: int


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    numbers = [int(n[:-5]) for n in files.names(spark, f"{path}/commits") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return None
    found = json.loads(files.read(spark, f"{path}/commits/{max(numbers):012d}.json"))
    return Commit(max(numbers), T.StructType.fromJson(found["schema"]), tuple(found["partition"]), found["live"], found["n_rows"])


def live_partitions(spark: SparkSession, path: str, commit: Commit) -> DataFrame:
    """(partition columns, write_id, n_rows) of a commit."""
    kinds = [T.StructField(c, commit.schema[c].dataType) for c in commit.partition]
    schema = T.StructType([*kinds, T.StructField(WRITE, T.StringType()), T.StructField("n_rows", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/live/{commit.live}")


def read(spark: SparkSession, path: str, commit: Commit | None = None, only: DataFrame | None = None) -> DataFrame:
    """Rows of a commit, by default the last. ``only`` names the partitions that are wanted.

    The schema comes from the commit, so no file is opened for it. Live partitions meet the scan in a
    broadcast semi join on its partition columns (a row a folder), which prunes the folders that are opened.
    """
    commit = commit or last_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"{path} has no commit")
    schema = T.StructType([*commit.schema.fields, T.StructField(WRITE, T.StringType())])
    keys = [*commit.partition, WRITE]
    live = live_partitions(spark, path, commit).filter("n_rows > 0")
    if only is not None:
        live = live.join(F.broadcast(only.select(*commit.partition).distinct()), list(commit.partition), "left_semi")
    rows = spark.read.schema(schema).parquet(f"{path}/data")
    return rows.join(F.broadcast(live.select(*keys)), keys, "left_semi").select(*commit.schema.names)


def _united(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The old columns, then those that are new; a column may not change its type."""
    fields = {f.name: f for f in (old.fields if old else [])}
    for f in new.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


def write(rows: DataFrame, path: str, partition: Sequence[str], replaces: DataFrame | None = None, check: Callable[[], None] | None = None) -> Commit:
    """Add ``rows``, or put them in the place of the partitions in ``replaces``, in one commit.

    Rows are written once. ``check`` runs after that and before the commit; when it, or anything else,
    raises, the table is as it was. Null partition values are refused.
    """
    spark, old = rows.sparkSession, last_commit(rows.sparkSession, path)
    if old is not None and old.partition != tuple(partition):
        raise ValueError(f"the table is partitioned by {old.partition}")
    schema, write_id = _united(old.schema if old else None, rows.schema), uuid.uuid4().hex
    data = f"{path}/data/{WRITE}={write_id}"
    try:
        rows.hint("rebalance", *partition).write.partitionBy(*partition).parquet(data)
        if check:
            check()
        kinds = T.StructType([schema[c] for c in partition])
        mine = spark.read.schema(T.StructType([f for f in rows.schema.fields if f.name not in partition] + kinds.fields)).parquet(data)
        live = mine.groupBy(*partition).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(WRITE, F.lit(write_id)).select(*partition, WRITE, "n_rows")
        if old is not None:
            kept = live_partitions(spark, path, old)
            if replaces is not None:
                kept = kept.join(F.broadcast(replaces.select(*partition).distinct()), list(partition), "left_anti")
            live = live.unionByName(kept)
        live.coalesce(1).write.parquet(f"{path}/live/{write_id}")
        missing = F.lit(False)
        for c in partition:
            missing = missing | F.col(c).isNull()
        seen = live_partitions(spark, path, Commit(0, schema, tuple(partition), write_id, 0)).agg(F.sum("n_rows"), F.count_if(missing)).first()
        if seen[1]:
            raise ValueError(f"rows without a value for {', '.join(partition)}")
        commit = Commit(old.number + 1 if old else 1, schema, tuple(partition), write_id, seen[0] or 0)
        text = {"schema": schema.jsonValue(), "partition": list(partition), "live": write_id, "n_rows": commit.n_rows}
        files.create(spark, f"{path}/commits/{commit.number:012d}.json", json.dumps(text))
    except BaseException:
        for folder in (data, f"{path}/live/{write_id}"):
            files.delete(spark, folder)
        if old is None and last_commit(spark, path) is None:
            files.delete(spark, path)
        raise
    return commit


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders that the last commit does not name: those of replaced rows and of broken writes. Run it when nobody reads or writes."""
    commit = last_commit(spark, path)
    if commit is None:
        return 0
    # One row for each write that still has live rows.
    alive = {r[0] for r in live_partitions(spark, path, commit).select(WRITE).distinct().collect()}
    gone = [f"{path}/data/{n}" for n in files.names(spark, f"{path}/data") if n.startswith(f"{WRITE}=") and n.split("=", 1)[1] not in alive]
    gone += [f"{path}/live/{n}" for n in files.names(spark, f"{path}/live") if n != commit.live]
    gone += [f"{path}/commits/{n}" for n in files.names(spark, f"{path}/commits") if n[:12] != f"{commit.number:012d}" and not n.startswith(".")]
    return sum(files.delete(spark, folder) for folder in gone)
