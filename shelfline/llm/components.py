"""Connected components of an edge table by alternating stars.

Each round joins a node's neighbours to its smallest neighbour (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). All steps are aggregates and joins on node ids, each
round is written to the shared folder, and nothing but two check numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import drop_staged, stage_at


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Self loops and repeated edges are harmless; an empty table gives an empty result. Nulls have no node.
    """
    spark = edges.sparkSession
    first = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND lo < hi")
    current, path = stage_at(first.distinct(), "edges")
    before = _mark(current)
    while before[0]:
        stars, next_path = stage_at(_small_star(_large_star(current)), "stars")
        drop_staged(spark, path)
        current, path, now = stars, next_path, _mark(stars)
        if now == before:
            break
        before = now
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(smallest, "hi").where("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.unionByName(smallest.select(F.col("m").alias("lo"), "hi")).distinct()
