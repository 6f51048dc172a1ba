"""Trend and season curves of many daily series, fitted by ridge least squares in column expressions.

A series' design has an intercept, a trend with hinges, weekly and yearly waves and regressors. What
a fit needs of the rows is the sums of their cross products. These are taken once per SKU and
*segment* of the calendar, and added up over segments: every cutoff of a rolling evaluation is one
prefix of these sums, so no refit reads rows again. Systems are solved by Cholesky factors in column
expressions (`functions.linear`); nothing leaves the JVM.

Input is daily sales, one row per SKU and day, so a segment holds at most as many rows as days.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions import linear as ln
from shelfline.session import spread

# Lengths of week and year in days, and the normal quantile of a 90% interval.
WEEK, YEAR = 7.0, 365.25
Z90 = 1.6448536269514722
#: Ridge of the columns that are not held back, and of hinges that are not in use.
FREE, BLOCKED = 1e-8, 1e9
FULL = -1  # the cut behind the last row: the fit to all of a series


@dataclass(frozen=True)
class Design:
    """Columns of the curve: intercept, trend, ``hinges`` in the trend, waves of ``weekly`` and ``yearly`` order, regressors."""

    weekly: int = 3
    yearly: int = 10
    hinges: int = 8
    regressors: tuple[str, ...] = field(default=())
    log: bool = False

    @property
    def knots(self) -> list[float]:
        return [(k + 1) / (self.hinges + 1) for k in range(self.hinges)]

    @property
    def size(self) -> int:
        return 2 + self.hinges + 2 * (self.weekly + self.yearly) + len(self.regressors)

    def row(self, day: Column, start: Column, end: Column, regressors: Sequence[Column] = ()) -> Column:
        """The design of one day of a series that runs from ``start`` to ``end``; a missing regressor counts as 0."""
        u = (day - start) / F.greatest(end - start, F.lit(1))
        waves = [(WEEK, k) for k in range(1, self.weekly + 1)] + [(YEAR, k) for k in range(1, self.yearly + 1)]
        angles = [day * F.lit(2 * math.pi * k / period) for period, k in waves]
        columns = [F.lit(1.0), u, *[F.greatest(F.lit(0.0), u - k) for k in self.knots]]
        columns += [wave for a in angles for wave in (F.sin(a), F.cos(a))]
        return F.array(*columns, *[F.coalesce(r.cast("double"), F.lit(0.0)) for r in regressors])

    def ridge(self, trend=0.05, season=10.0, extra=10.0, used: Column | int | None = None) -> Column:
        """Penalties of the columns: the inverse of each prior scale. Only the first ``used`` hinges are in use."""
        one = lambda scale: F.lit(1.0) / scale if isinstance(scale, Column) else F.lit(1.0 / scale)
        hinges = [one(trend) if used is None else F.when(F.lit(k) < used, one(trend)).otherwise(BLOCKED) for k in range(self.hinges)]
        return F.array(F.lit(FREE), F.lit(FREE), *hinges, *[one(season)] * (2 * (self.weekly + self.yearly)), *[one(extra)] * len(self.regressors))

    def used_hinges(self, seen: Column, reach: Column | float = 0.8) -> Column:
        """Hinges within ``reach`` of the share of the series that is seen."""
        return sum((F.when(F.lit(k) <= F.lit(reach) * seen, 1).otherwise(0) for k in self.knots), F.lit(0))

    def target(self, value: Column) -> Column:
        return F.log1p(F.greatest(value, F.lit(0.0))) if self.log else value

    def back(self, value: Column) -> Column:
        return F.expm1(value) if self.log else value


def series_points(daily: DataFrame, design: Design, minimum: int) -> DataFrame:
    """(product_id, day, start, end, n, y, x) of series with ``minimum`` rows or more; days are counted from 1970."""
    whole = Window.partitionBy("product_id")
    known = daily.filter(F.col("quantity").isNotNull()).select(
        "product_id", F.unix_date("date").alias("day"), F.col("quantity").cast("double").alias("y"), *design.regressors
    )
    placed = known.withColumns({"start": F.min("day").over(whole), "end": F.max("day").over(whole), "n": F.count(F.lit(1)).over(whole)})
    x = design.row(F.col("day"), F.col("start"), F.col("end"), [F.col(r) for r in design.regressors])
    return placed.filter(F.col("n") >= minimum).select("product_id", "day", "start", "end", "n", "y", x.alias("x"))


def cross_products(rows: DataFrame, keys: Sequence[str], size: int, weight: str | None = None) -> DataFrame:
    """(keys, sums, n): the symmetric matrix of the summed products of ``row``, an array of ``size`` numbers, for each key; rows may have a weight.

    A row is taken once for each of its numbers, so that one compiled aggregate with ``size`` sums adds up
    all products, combined before the shuffle.
    """
    each = rows.select(*keys, "row", *([weight] if weight else []), F.posexplode("row").alias("i", "v"))
    if weight:
        each = each.withColumn("v", F.col("v") * F.col(weight))
    summed = each.groupBy(*keys, "i").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("v") * F.get("row", F.lit(j))) for j in range(size)]).alias("r"))
    listed = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "r"))).alias("rows"), F.max("n").alias("n"))
    return listed.select(*keys, F.transform("rows", lambda r: F.slice(r["r"], F.lit(1), r["i"] + 1)).alias("sums"), F.col("n").cast("int").alias("n"))


def prefix_systems(rows: DataFrame, marks: DataFrame, size: int) -> DataFrame:
    """(product_id, cut, sums, n_train): the summed cross products of the rows of ``cut`` or a higher number.

    ``rows``: product_id, cut and ``row``, an array of ``size`` numbers; ``marks`` names the cuts that
    are asked for. Rows are added up once for each cut, then cuts are added up from the highest down.
    """
    keys = ["product_id", "cut"]
    asked = marks.select(*keys, F.lit(True).alias("asked"))
    zero = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.array_repeat(F.lit(0.0), i + 1))
    parts = cross_products(rows.select(*keys, "row"), keys, size).join(asked, keys, "full")
    parts = parts.select(*keys, F.coalesce("asked", F.lit(False)).alias("asked"), F.coalesce("sums", zero).alias("sums"), F.coalesce("n", F.lit(0)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("cut")).alias("place"), "cut", "asked", "sums", "n")))
    add = lambda a, b: F.zip_with(a, b, lambda p, q: F.zip_with(p, q, lambda x, y: x + y))
    first = F.struct(zero.alias("sums"), F.lit(0).alias("n"), F.array().cast("array<struct<cut:int,asked:boolean,sums:array<array<double>>,n:int>>").alias("out"))

    def climb(state: Column, part: Column) -> Column:
        grown = F.struct(add(state["sums"], part["sums"]).alias("sums"), (state["n"] + part["n"]).alias("n"))
        return ln.let(grown, lambda g: F.struct(
            g["sums"].alias("sums"), g["n"].alias("n"),
            F.array_append(state["out"], F.struct(part["cut"].alias("cut"), part["asked"].alias("asked"), g["sums"].alias("sums"), g["n"].alias("n"))).alias("out"),
        ))

    summed = parts.groupBy("product_id").agg(ordered.alias("parts")).select("product_id", F.explode(F.aggregate("parts", first, climb)["out"]).alias("p"))
    return spread(summed.filter("p.asked").select("product_id", "p.cut", "p.sums", F.col("p.n").alias("n_train")), "product_id", "cut")


def cut_of_row(day: Column, end: Column, last_cut: Column, horizon: int, period: int) -> Column:
    """Number of the earliest cutoff whose history holds the day: cutoff k lies ``horizon`` + k ``period`` days before the end."""
    steps = F.floor((end - horizon - day) / F.lit(period)).cast("int")
    return F.when((steps >= 0) & (last_cut >= 0), F.least(steps, last_cut)).otherwise(FULL)


def last_cutoff(start: Column, end: Column, horizon: int, period: int, initial: int) -> Column:
    """Number of the earliest cutoff with ``initial`` days of history, -1 when there is none."""
    return F.greatest(F.floor((end - horizon - start - initial) / F.lit(period)).cast("int"), F.lit(-1))


def tested_cuts(day: Column, end: Column, last_cut: Column, horizon: int, period: int) -> Column:
    """Numbers of the cutoffs whose horizon holds the day."""
    near = F.greatest(F.floor((end - horizon - day) / F.lit(period)).cast("int") + 1, F.lit(0))
    far = F.least(F.floor((end - day) / F.lit(period)).cast("int"), last_cut)
    return F.when(far >= near, F.sequence(near, far))


def rolling_tests(points: DataFrame, extra: Sequence[str], horizon: int, period: int, initial: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their cut, the cuts of every series (and the full one), and each cut's test rows as an array ``tests`` of (y, the ``extra`` columns)."""
    last = last_cutoff(F.col("start"), F.col("end"), horizon, period, initial)
    placed = points.withColumn("_last", last)
    rows = placed.withColumn("cut", cut_of_row(F.col("day"), F.col("end"), F.col("_last"), horizon, period))
    spans = placed.groupBy("product_id").agg(F.first("start").alias("start"), F.first("end").alias("end"), F.first("n").alias("n"), F.first("_last").alias("_last"))
    cuts = spans.select("product_id", "start", "end", "n", F.explode(F.sequence(F.lit(FULL), F.col("_last"))).alias("cut"))
    hit = placed.select("product_id", F.struct("y", *extra).alias("test"), F.explode(tested_cuts(F.col("day"), F.col("end"), F.col("_last"), horizon, period)).alias("cut"))
    tests = hit.groupBy("product_id", "cut").agg(F.collect_list("test").alias("tests"))
    return rows, cuts, tests


def solved(systems: DataFrame, size: int, ridge: Column) -> DataFrame:
    """Systems with ``beta`` and ``half``, half of the 90% interval; the target is the last of the ``size`` + 1 numbers of a row.

    The interval has the noise and the mean uncertainty that the columns in use bring with them.
    """
    last = F.get("sums", F.lit(size))
    ready = systems.withColumn("_ridge", ridge).withColumn("_b", F.slice(last, 1, size))
    lower = ready.withColumn("_lower", ln.factor(F.slice("sums", 1, size), F.col("_ridge")))
    with_beta = lower.withColumn("beta", ln.backward(F.col("_lower"), ln.forward(F.col("_lower"), F.col("_b"))))
    held = ln.dot(F.col("_ridge"), F.transform("beta", lambda v: v * v))
    rest = F.greatest(F.get(last, F.lit(size)) - ln.dot(F.col("_b"), F.col("beta")) - held, F.lit(0.0))
    free = F.size(F.filter("_ridge", lambda r: r < BLOCKED))
    sigma = F.sqrt(rest / F.greatest(F.col("n_train") - free, F.lit(1)))
    half = F.lit(Z90) * sigma * F.sqrt(1 + free / F.greatest(F.col("n_train"), F.lit(1)))
    return with_beta.withColumn("half", half).drop("sums", "_ridge", "_b", "_lower")


def percent_base(y: Column) -> Column:
    return F.when(F.abs(y) < 1e-8, F.lit(1.0)).otherwise(F.abs(y))


def test_errors(design: Design) -> Column:
    """Array of (error, share, inside) of the ``tests`` of a solved system."""

    def one(t: Column) -> Column:
        return ln.let(ln.fixed_dot(t["x"], F.col("beta"), design.size), lambda m: ln.let(F.abs(t["y"] - design.back(m)), lambda error: F.struct(
            error.alias("error"), (error / percent_base(t["y"])).alias("share"),
            F.when((t["y"] >= design.back(m - F.col("half"))) & (t["y"] <= design.back(m + F.col("half"))), 1.0).otherwise(0.0).alias("inside"),
        )))

    return F.transform("tests", one)


def future_days(spans: DataFrame, design: Design, horizon: int, future: DataFrame | None = None) -> DataFrame:
    """(product_id, day, date, x) of the ``horizon`` days behind each series.

    ``future`` holds what is known ahead: date, the regressors, and product_id where they differ by
    SKU. A day or value that it does not have counts as 0.
    """
    days = spans.select("product_id", "start", "end", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    days = days.withColumn("day", F.col("end") + F.col("step")).withColumn("date", F.date_from_unix_date("day"))
    if future is not None and design.regressors:
        keys = [c for c in ("product_id", "date") if c in future.columns]
        present = [r for r in design.regressors if r in future.columns]
        days = days.join(future.select(*keys, *present), keys, "left")
    regressors = [F.col(r) if r in days.columns else F.lit(0.0) for r in design.regressors]
    return days.select("product_id", "step", "day", "date", design.row(F.col("day"), F.col("start"), F.col("end"), regressors).alias("x"))
