"""Augmented Dickey–Fuller test of many daily series, from one set of lag products per series.

With dx the differences and c the centred levels, every entry of the normal equations is a full lag
product less what lies at the ends of the series: sum over t >= s of dx[t-i] dx[t-j] is the product at
lag j - i without its first s - j and its last i terms. So one compiled aggregate takes L + 1 products of
differences and as many of levels with differences, the first and last L values are kept in arrays, and
the systems of every lag count and every sample start follow without reading rows again, each entry from
the one before it on its diagonal. One factor of
the longest model gives the residual sums of all nested ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions import linear as ln
from shelfline.functions.scalars import normal_cdf
from shelfline.session import spread

# MacKinnon's response surface for a unit-root test with constant (one variable).
TAU_RANGE = (-18.83, -1.61, 2.74)
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
#: A residual sum below this share of the total is a perfect fit, which has no test.
PERFECT = 1e-12


def unit_root_p(tau: Column) -> Column:
    """p-value of the test statistic; null stays null."""
    low, border, high = TAU_RANGE

    def surface(powers) -> Column:
        return sum((F.lit(c) * F.pow(tau, F.lit(i)) for i, c in enumerate(powers)), F.lit(0.0))

    inner = normal_cdf(F.when(tau <= border, surface(TAU_SMALL)).otherwise(surface(TAU_LARGE)))
    return F.when(tau <= low, 0.0).when(tau >= high, 1.0).otherwise(inner)


def longest_lag(n: Column) -> Column:
    """Schwert's rule for a series of n values, with two degrees of freedom left."""
    rule = F.ceil(F.lit(12) * F.pow(n / 100, F.lit(0.25)))
    return F.greatest(F.lit(0), F.least(rule, F.floor(n / 2) - 2)).cast("int")


def level_and_change(daily: DataFrame, value: str, minimum: int) -> DataFrame:
    """(product_id, n, d, date, v): each series of ``minimum`` values or more (d = 0) and its first difference (d = 1)."""
    known = spread(daily.filter(F.col(value).isNotNull()).select("product_id", "date", F.col(value).cast("double").alias("v")), "product_id")
    before = F.lag("v").over(Window.partitionBy("product_id").orderBy("date"))
    placed = known.withColumns({"w": F.col("v") - before, "n": F.count(F.lit(1)).over(Window.partitionBy("product_id"))})
    both = F.array(*[F.struct(F.lit(d).alias("d"), F.col(c).alias("v")) for d, c in enumerate("vw")])
    return placed.filter(F.col("n") >= minimum).select("product_id", "n", "date", F.inline(both)).filter(F.col("v").isNotNull())


def lag_sums(series: DataFrame, keys: list[str], lags: int) -> DataFrame:
    """Per series: sums of products up to ``lags``, and the first and last values that the systems need."""
    own = Window.partitionBy(*keys)
    order = own.orderBy("date")
    placed = series.withColumns({"t": F.row_number().over(order) - 1, "m": F.count(F.lit(1)).over(own), "c": F.col("v") - F.avg("v").over(own)})
    moved = placed.withColumn("dx", F.lead("c").over(order) - F.col("c")).withColumn("l", longest_lag(F.col("m")))
    shifted = moved.withColumns({f"_{k}": F.lag("dx", k).over(order) for k in range(1, lags + 1)}).filter(F.col("dx").isNotNull())
    past = [F.col("dx"), *[F.col(f"_{k}") for k in range(1, lags + 1)]]
    zero = lambda v: F.coalesce(F.sum(v), F.lit(0.0))
    ends = lambda held, *parts: F.array_sort(F.collect_list(F.when(held, F.struct("t", *parts))))
    summed = shifted.groupBy(*keys).agg(
        (F.first("m") - 1).cast("int").alias("rows"), F.first("l").alias("l"), F.first("n").alias("n"),
        F.array(*[zero(F.col("dx") * p) for p in past]).alias("dd"), F.array(*[zero(F.col("c") * p) for p in past]).alias("cd"),
        F.sum("dx").alias("sd"), F.sum("c").alias("sc"), F.sum(F.col("c") * F.col("c")).alias("cc"),
        ends(F.col("t") < F.col("l"), "dx", "c").alias("_head"), ends(F.col("t") >= F.col("m") - 1 - F.col("l"), "dx").alias("_tail"),
    )
    part = lambda side, name: F.transform(side, lambda p: p[name])
    return summed.withColumns({"head": part("_head", "dx"), "level": part("_head", "c"), "tail": part("_tail", "dx")}).drop("_head", "_tail")


class Entries:
    """Entries of the normal equations of the rows from place ``s`` on; lag 0 is the difference that is explained."""

    def __init__(self, s: Column):
        self.s, self.l = s, F.col("l")

    def _first(self, array: str, start: Column, count: Column) -> Column:
        return F.slice(F.col(array), start.cast("int"), count.cast("int"))

    def count(self) -> Column:
        return (F.col("rows") - self.s).cast("double")

    def explained(self, j: Column) -> Column:
        """Lag 0 with lag j."""
        return F.get("dd", j) - ln.dot(self._first("head", j + 1, self.s - j), self._first("head", F.lit(1), self.s - j))

    def differences(self, lags: Column) -> Column:
        """Rows j = 0 … ``lags`` with the entries of lags 0 … j. Each follows from the one before in both lags: a term comes in front, one goes behind."""

        def row(above: Column, j: Column) -> Column:
            gained = lambda q: F.get("head", self.s - q - 1) * F.get("head", self.s - j)
            lost = lambda q: F.get("tail", self.l - q - 1) * F.get("tail", self.l - j)
            return F.array_prepend(F.transform(above, lambda v, q: v + gained(q) - lost(q)), self.explained(j))

        start = F.array(F.array(self.explained(F.lit(0))))
        return F.aggregate(self.lags(lags), start, lambda done, j: F.array_append(done, row(F.element_at(done, -1), j)))

    def level(self, j: Column) -> Column:
        return F.get("cd", j) - ln.dot(self._first("level", j + 1, self.s - j), self._first("head", F.lit(1), self.s - j))

    def total(self, j: Column) -> Column:
        return F.col("sd") - _sum(self._first("head", F.lit(1), self.s - j)) - _sum(self._first("tail", self.l - j + 1, j))

    def level_total(self) -> Column:
        return F.col("sc") - _sum(self._first("level", F.lit(1), self.s))

    def level_square(self) -> Column:
        head = self._first("level", F.lit(1), self.s)
        return F.col("cc") - ln.dot(head, head)

    def lags(self, upto: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.greatest(upto, F.lit(1))), lambda k: k <= upto)


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, v: a + v)


def _solved(matrix: Column, right: Column) -> Column:
    """What each column explains beyond the earlier ones; ``right`` is bound, as the steps of the solution read it again and again."""
    return ln.let(right, lambda r: ln.forward(ln.factor(matrix), r))


def best_lags(sums: DataFrame) -> DataFrame:
    """Adds ``best``: the lag count with the least AIC, all on the rows that the longest model has; ties go to fewer lags."""
    at, zero = Entries(F.col("l")), F.lit(0)
    ready = sums.withColumn("_d", at.differences(F.col("l")))
    own = lambda r: ln.let(F.size(r) - 1, lambda j: F.concat(F.array(at.total(j), at.level(j)), F.slice(r, F.lit(2), j)))
    lagged = F.slice("_d", F.lit(2), F.col("l"))
    matrix = F.concat(F.array(F.array(at.count()), F.array(at.level_total(), at.level_square())), F.transform(lagged, own))
    right = F.concat(F.array(at.total(zero), at.level(zero)), F.transform(lagged, lambda r: r[0]))
    ready = ready.withColumns({"_m": matrix, "_r": right, "_yy": F.col("_d")[0][0]})
    rest = lambda z, k: F.greatest(F.col("_yy") - _sum(F.slice(z, F.lit(1), k + 2)), F.lit(1e-300))
    score = lambda z, k: at.count() * F.log(rest(z, k) / at.count()) + 2 * (k + 2)
    scores = lambda z: F.transform(F.sequence(F.lit(0), F.col("l")), lambda k: F.struct(score(z, k).alias("aic"), k.alias("k")))
    squares = F.transform(_solved(F.col("_m"), F.col("_r")), lambda z: z * z)
    return ready.withColumn("best", ln.let(squares, lambda z: F.array_min(scores(z))["k"])).drop("_d", "_m", "_r", "_yy")


def statistics(chosen: DataFrame) -> DataFrame:
    """Adds ``tau``, the t statistic of the level on all rows that the chosen lag count leaves.

    The level is the last column, so its part of the factored system is all that is needed. Null for
    constant series and for perfect fits.
    """
    best = F.col("best")
    at, zero = Entries(best), F.lit(0)
    ready = chosen.withColumn("_d", at.differences(best))
    own = lambda r: ln.let(F.size(r) - 1, lambda j: F.array_prepend(F.slice(r, F.lit(2), j), at.total(j)))
    lagged = F.slice("_d", F.lit(2), best)
    level = F.concat(F.array(at.level_total()), F.transform(at.lags(best), at.level), F.array(at.level_square()))
    matrix = F.concat(F.array(F.array(at.count())), F.transform(lagged, own), F.array(level))
    right = F.concat(F.array(at.total(zero)), F.transform(lagged, lambda r: r[0]), F.array(at.level(zero)))
    solved = ready.withColumns({"_m": matrix, "_r": right, "_yy": F.col("_d")[0][0]}).withColumn("_z", _solved(F.col("_m"), F.col("_r")))
    rest = F.col("_yy") - ln.dot(F.col("_z"), F.col("_z"))
    spare = F.greatest(F.col("rows") - 2 * best - 2, F.lit(1))
    tau = F.when(rest > PERFECT * F.col("_yy"), F.element_at("_z", -1) / F.sqrt(rest / spare))
    return solved.withColumn("tau", tau).drop("_d", "_m", "_r", "_yy", "_z")


def adf(daily: DataFrame, value: str = "quantity", minimum: int = 30) -> DataFrame:
    """(product_id, n, adf_lags, adf_p, adf_diff_p) of series with ``minimum`` values or more; a constant or perfectly explained one has no p-value."""
    series = level_and_change(daily, value, minimum)
    most = daily.filter(F.col(value).isNotNull()).groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    # The lag count grows with the fourth root of the calendar.
    lags = max(0, min(math.ceil(12 * (most / 100) ** 0.25), most // 2 - 2))
    tested = statistics(best_lags(lag_sums(series, ["product_id", "d"], lags))).withColumn("p", unit_root_p(F.col("tau")))
    of = lambda d, c: F.max(F.when(F.col("d") == d, F.col(c)))
    return tested.groupBy("product_id").agg(F.max("n").alias("n"), of(0, "best").alias("adf_lags"), of(0, "p").alias("adf_p"), of(1, "p").alias("adf_diff_p"))
