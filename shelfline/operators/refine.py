"""Exact order statistics by refinement: counts on a grid, then only the cells that can hold the answer.

The first pass counts the rows of each column on a fixed grid of 256 cells an octave, which needs no
bounds and combines before the shuffle. A quantile lies in one cell; the largest gap between two
distributions lies in a cell whose counts allow a larger one than is seen at the cells' ends. Only
rows of these cells are looked at again, on a finer grid between the cell's smallest and largest
value, or value by value once a cell has few rows. Nothing is sorted but cells and the values of small
cells, and no copy of the data is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.operators.ordered import global_rank
from shelfline.session import stage_table

#: Cells an octave, finer cells of an opened cell, and the rows up to which a cell is opened value by value.
OCTAVE, FINER, SORTED = 256, 4096, 100_000
#: Beyond the grid numbers of all finite values, so that signs and zero stay apart.
OFFSET = 1 << 20


def grid_cell(value: Column) -> Column:
    """Number of a value's cell; it never falls when the value grows."""
    size = F.when(F.abs(value) == float("inf"), F.lit(OFFSET)).otherwise(F.floor(F.log2(F.abs(value)) * OCTAVE)) + 2 * OFFSET
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("long")


def finer_cell(value: Column, lo: Column, hi: Column) -> Column:
    """Place of a value on an even grid from lo to hi; halves keep the differences finite."""
    return F.least(F.floor((value / 2 - lo / 2) / (hi / 2 - lo / 2) * FINER), F.lit(FINER - 1)).cast("long")


def _opened(rows: DataFrame, cells: DataFrame, group: str, carried: Sequence[str], by_value: bool) -> DataFrame:
    """Rows of the given cells (group, path, lo, hi, carried) with the path of their finer cell and that of the parent."""
    inside = rows.join(cells.select(group, "path", "lo", "hi", *carried), [group, "path"]).withColumn("parent", F.col("path"))
    step = F.xxhash64("value") if by_value else finer_cell(F.col("value"), F.col("lo"), F.col("hi"))
    path = F.when(F.col("lo") < F.col("hi"), F.array_append("path", step)).otherwise(F.col("path"))
    return inside.withColumn("path", path).drop("lo", "hi")


def _at_ranks(known: DataFrame, group: str, asked: Column) -> DataFrame:
    """(group, which, rank, total, lo, n, before) of the values at the asked ranks of (group, value): ``before`` rows are smaller, ``n`` equal.

    ``asked`` is an array of (which, rank) worked out from ``total``, with ranks counted from 0.
    """
    rows = known.withColumn("path", F.array(grid_cell(F.col("value"))))
    counted = [F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    cells = rows.groupBy(group, "path").agg(*counted)
    order = Window.partitionBy(group).orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy(group))})
    ranks = placed.select("*", F.inline(asked))
    held = ranks.filter((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
    wanted = [group, "which", "rank", "total"]
    targets = stage_table(held.select(*wanted, "path", "lo", "hi", "n", (F.col("upto") - F.col("n")).alias("before")), "quantile-cells")
    while True:
        largest = targets.filter("lo < hi").agg(F.max("n")).first()[0]
        if largest is None:
            return targets
        cells = targets.filter("lo < hi").select(group, "path", "lo", "hi", "before").distinct()
        inside = _opened(rows, cells, group, ["before"], largest <= SORTED)
        finer = inside.groupBy(group, "parent", "before", "path").agg(*counted)
        order = Window.partitionBy(group, "parent").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
        finer = finer.withColumn("upto", F.col("before") + F.sum("n").over(order)).withColumn("before", F.col("upto") - F.col("n"))
        met = targets.filter("lo < hi").select(*wanted, F.col("path").alias("parent")).join(finer, [group, "parent"])
        met = met.filter((F.col("upto") > F.col("rank")) & (F.col("before") <= F.col("rank")))
        targets = stage_table(targets.filter("lo = hi").unionByName(met.select(*targets.columns)), "quantile-cells")
        rows = inside.drop("before", "parent")


def exact_quantiles(long: DataFrame, probs: Sequence[float], group: str = "column", value: str = "value") -> DataFrame:
    """Linearly interpolated exact quantiles per group: columns ``n_values``, ``q0, q1, …``. Null values do not count.

    Made for few groups, such as the columns of a table. Groups without values are absent.
    """
    known = long.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("value"))
    place = lambda p: (F.col("total") - 1) * F.lit(float(p))
    asked = F.array(*[
        F.struct(F.lit(2 * i + side).alias("which"), rounded(place(p)).cast("long").alias("rank"))
        for i, p in enumerate(probs) for side, rounded in enumerate((F.floor, F.ceil))
    ])
    pick = lambda k: F.max(F.when(F.col("which") == k, F.col("lo"))).alias(f"_{k}")
    found = _at_ranks(known, group, asked).groupBy(group).agg(F.max("total").alias("n_values"), *[pick(k) for k in range(2 * len(probs))])
    out = []
    for i, p in enumerate(probs):
        place, lo, hi = (F.col("n_values") - 1) * F.lit(float(p)), F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        out.append((lo + (hi - lo) * (place - F.floor(place))).alias(f"q{i}"))
    return found.select(group, "n_values", *out)


def smallest_rows(
    df: DataFrame, value: Column, ties: Sequence[Column], wanted: Callable[[Column], Column], name: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Adds ``name``: whether a row is one of the ``wanted(total)`` smallest of its key by ``value``, then by ``ties``.

    The cut value is found by refinement, so rows are neither sorted nor written; only rows equal to
    the cut value are ranked, and only where not all of them are wanted. Null and NaN come last. Made
    for few keys; null is a key too. ``df`` is read several times.
    """
    group, size, cut, need, same = (fresh(df, c) for c in ("group", "size", "cut", "need", "same"))
    last = F.lit(float("inf"))
    sized = df.withColumns({size: F.coalesce(F.nanvl(value.cast("double"), last), last), group: F.to_json(F.struct(*keys)) if keys else F.lit("")})
    asked = F.array(F.struct(F.lit(0).alias("which"), (wanted(F.col("total")) - 1).cast("long").alias("rank")))
    found = _at_ranks(sized.select(F.col(group).alias("group"), F.col(size).alias("value")), "group", asked)
    limits = found.select(F.col("group").alias(group), F.col("lo").alias(cut), (F.col("rank") + 1 - F.col("before")).alias(need), F.col("n").alias(same))
    marked = sized.join(limits, group, "left")
    torn = F.coalesce((F.col(size) == F.col(cut)) & (F.col(need) < F.col(same)), F.lit(False))
    plain = marked.filter(~torn).withColumn(name, F.coalesce(F.col(size) <= F.col(cut), F.lit(False)))
    out = plain.select(*df.columns, name)
    if limits.filter(F.col(need) < F.col(same)).isEmpty():
        return out
    place = fresh(df, "place")
    ranked = global_rank(marked.filter(torn), list(ties), place, keys=[group])
    return out.unionByName(ranked.withColumn(name, F.col(place) <= F.col(need)).select(*df.columns, name))


def fresh(df: DataFrame, name: str) -> str:
    """A helper column's name that the frame does not have."""
    name = "_" + name
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def largest_gap(rows: DataFrame, group: str = "column") -> DataFrame:
    """(group, gap, n_ref, n_prod): the largest distance between the two distribution functions of (group, value, n_ref, n_prod).

    ``n_ref`` and ``n_prod`` say how often a row counts on each side. The gap is null where a side is empty.
    """
    rows = rows.select(group, "value", "n_ref", "n_prod").withColumn("path", F.array(grid_cell(F.col("value"))))
    summed = [F.sum("n_ref").alias("n_ref"), F.sum("n_prod").alias("n_prod"), F.min("value").alias("lo"), F.max("value").alias("hi")]
    cells = rows.groupBy(group, "path").agg(*summed)
    own = Window.partitionBy(group)
    upto = own.orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumns({"all_ref": F.sum("n_ref").over(own), "all_prod": F.sum("n_prod").over(own), "ref": F.sum("n_ref").over(upto), "prod": F.sum("n_prod").over(upto)})
    carried = ["ref0", "prod0", "all_ref", "all_prod"]

    def gap(ref: Column, prod: Column) -> Column:
        return F.abs(F.try_divide(ref, F.col("all_ref")) - F.try_divide(prod, F.col("all_prod")))

    def bounded(cells: DataFrame) -> DataFrame:
        """Cells with the gap at their end and the largest one that may lie inside."""
        before = cells.withColumns({"ref0": F.col("ref") - F.col("n_ref"), "prod0": F.col("prod") - F.col("n_prod"), "gap": gap(F.col("ref"), F.col("prod"))})
        most = F.greatest(gap(F.col("ref"), F.col("prod0")), gap(F.col("ref0"), F.col("prod")))
        return before.withColumn("most", F.when(F.col("lo") < F.col("hi"), most).otherwise(F.col("gap")))

    level = stage_table(bounded(cells), "gap-cells")
    best = level.groupBy(group).agg(F.max("gap").alias("gap"), F.max("all_ref").alias("n_ref"), F.max("all_prod").alias("n_prod"))
    best = stage_table(best, "gap-best")
    while True:
        open_ = level.join(best.select(group, F.col("gap").alias("_best")), group).filter((F.col("most") > F.col("_best")) & (F.col("lo") < F.col("hi")))
        largest = open_.agg(F.max(F.col("n_ref") + F.col("n_prod"))).first()[0]
        if largest is None:
            return best
        inside = _opened(rows, open_, group, carried, largest <= SORTED)
        finer = inside.groupBy(group, "parent", "path", *carried).agg(*summed)
        order = Window.partitionBy(group, "parent").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
        finer = finer.withColumns({"ref": F.col("ref0") + F.sum("n_ref").over(order), "prod": F.col("prod0") + F.sum("n_prod").over(order)})
        level = stage_table(bounded(finer.drop("ref0", "prod0")), "gap-cells")
        more = level.groupBy(group).agg(F.max("gap").alias("_more"))
        best = stage_table(best.join(more, group, "left").select(group, F.greatest("gap", "_more").alias("gap"), "n_ref", "n_prod"), "gap-best")
        rows = inside.select(group, "value", "n_ref", "n_prod", "path")
