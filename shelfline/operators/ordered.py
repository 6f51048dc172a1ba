"""Ordered operators that never gather one whole key, or the whole table, in one task.

An ordered window without ``partitionBy`` (or over one hot key) runs in a single task.
Here rows are range-partitioned into *slabs*, each slab is scanned on its own, and the
state at the end of the earlier slabs is added. A slab edge cuts at most one key, so the
carried state has fewer rows than there are slabs and can always be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from shelfline.session import stage_table

SLAB = "_slab"


def _slabs(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return stage_table(ranged.withColumn(SLAB, F.spark_partition_id()), "slabs")


def _earlier_slabs(keys: Sequence[str]) -> WindowSpec:
    # At most one row per slab and key: without keys this is one row per slab.
    return Window.partitionBy(*keys).orderBy(SLAB).rowsBetween(Window.unboundedPreceding, -1)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: dict[str, Column],
    keys: Sequence[str] = (),
    with_totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums in ``order`` within ``keys``.

    ``order`` must be unique within a key; equal rows would otherwise be cut arbitrarily.
    ``with_totals`` also adds the sum over the whole key as ``<name>_total``.
    """
    staged = _slabs(df, keys, order)
    group = [SLAB, *keys]
    per_slab = staged.groupBy(*group).agg(*[F.sum(c).alias(f"_part_{n}") for n, c in sums.items()])
    whole = Window.partitionBy(*keys)
    carried = per_slab.select(
        *group,
        F.count(F.lit(1)).over(_earlier_slabs(keys)).alias("_slabs_before"),
        *[F.sum(f"_part_{n}").over(_earlier_slabs(keys)).alias(f"_carried_{n}") for n in sums],
        *[F.sum(f"_part_{n}").over(whole).alias(f"{n}_total") for n in sums if with_totals],
    )
    if with_totals:
        # One row per key and slab: with many keys this is large, so the planner picks the join.
        joined = staged.join(carried, group)
    else:
        # Only keys cut by a slab edge remain: fewer rows than slabs.
        joined = staged.join(F.broadcast(carried.filter("_slabs_before > 0")), group, "left")
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(within) + F.coalesce(f"_carried_{n}", F.lit(0))).alias(n) for n, c in sums.items()],
        *[F.col(f"{n}_total") for n in sums if with_totals],
    )


def global_rank(
    df: DataFrame, order: Sequence[Column], name: str = "rank", keys: Sequence[str] = (), with_totals: bool = False
) -> DataFrame:
    """1-based row number in ``order`` within ``keys``, without a one-task sort."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, keys, with_totals)


def as_of_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    entity_ts: str,
    feature_ts: str,
    values: Sequence[str],
    ttl_days: int | None = None,
) -> DataFrame:
    """Left as-of join: per entity row the newest feature row at or before its time.

    A feature older than ``ttl_days`` counts as missing. Rows of one hot key are spread over
    several slabs; the newest feature of earlier slabs is carried in.
    """
    time = F.col(entity_ts)
    payload = F.struct(*[F.col(c) for c in entities.columns])
    empty_feature = F.struct(
        F.lit(None).cast(features.schema[feature_ts].dataType).alias("_at"),
        *[F.lit(None).cast(features.schema[v].dataType).alias(v) for v in values],
    )
    feature = F.struct(F.col(feature_ts).alias("_at"), *[F.col(v) for v in values])
    left = entities.select(
        *keys, time.alias("_ts"), F.lit(1).alias("_kind"), F.xxhash64(payload).alias("_spread"),
        payload.alias("_entity"), F.when(F.lit(False), empty_feature).alias("_feature"),
    )
    right = features.select(
        *keys, F.col(feature_ts).alias("_ts"), F.lit(0).alias("_kind"), F.xxhash64(feature).alias("_spread"),
        feature.alias("_feature"),
    ).filter(F.col("_ts").isNotNull())
    both = left.unionByName(right, allowMissingColumns=True)
    order = [F.col("_ts"), F.col("_kind"), F.col("_spread")]
    staged = _slabs(both, keys, order)
    group = [SLAB, *keys]
    newest = staged.groupBy(*group).agg(
        F.max(F.when(F.col("_kind") == 0, F.struct("_ts", "_spread", "_feature")))["_feature"].alias("_newest")
    )
    carried = newest.select(
        *group, F.last("_newest", ignorenulls=True).over(_earlier_slabs(keys)).alias("_carried")
    ).filter(F.col("_carried").isNotNull())
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = staged.join(F.broadcast(carried), group, "left").withColumn(
        "_seen", F.coalesce(F.last("_feature", ignorenulls=True).over(within), F.col("_carried"))
    )
    hit = F.col("_seen")
    fresh = hit.isNotNull()
    if ttl_days is not None:
        fresh = fresh & (hit["_at"] >= F.col("_ts") - F.expr(f"INTERVAL {ttl_days} DAYS"))
    return seen.filter(F.col("_kind") == 1).select(
        "_entity.*",
        *[F.when(fresh, hit[v]).alias(v) for v in values],
        F.when(fresh, hit["_at"]).alias("feature_ts"),
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``. Rank filters run before the shuffle, so hot keys stay small."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


def day_spine(daily: DataFrame, key: str, date: str, value: str) -> DataFrame:
    """Fill calendar gaps between the first and last day of each key with zero."""
    span = daily.groupBy(key).agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    days = span.select(key, F.explode(F.sequence("_from", "_to")).alias(date))
    filled = days.join(daily.select(key, date, value), [key, date], "left")
    zero = F.lit(0).cast(daily.schema[value].dataType)
    return filled.withColumn(value, F.coalesce(F.col(value), zero))


def unpivot_numeric(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form (column, value) of numeric columns; NaN becomes null."""
    casted = df.select(*ids, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    return casted.unpivot(list(ids), list(columns), "column", "value")


def one_row(df: DataFrame, **aggregates: Column) -> Column:
    """A struct of whole-table aggregates as a scalar subquery column."""
    return df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("stats")).scalar()


def decimal_sum(column: Column) -> Column:
    """Exact money sum: cast to a fixed scale before adding, so that order cannot matter."""
    return F.sum(column.cast(T.DecimalType(18, 4)))
