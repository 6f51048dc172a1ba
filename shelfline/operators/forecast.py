"""Per-SKU forecasting: seasonal curves, rolling evaluation, parameter search, orders of ARIMA, quantiles.

Curves and their evaluation rest on `operators.curves`: summed cross products, solved in column
expressions. Input is daily sales, one row per SKU and day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions import linear as ln
from shelfline.functions.scalars import winner_by_min
from shelfline.operators import curves
from shelfline.operators.curves import Design
from shelfline.session import spread, stage_table

# The search space, the fixed order and the horizons of the error curve.
SEARCH_SPACE = {
    "changepoint_prior_scale": [0.001, 0.01, 0.05, 0.1, 0.5],
    "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0],
    "holidays_prior_scale": [0.01, 0.1, 1.0, 10.0],
    "seasonality_mode": ["additive", "multiplicative"],
    "changepoint_range": [0.80, 0.85, 0.90, 0.95],
}
DEFAULT_PARAMETERS = {
    "changepoint_prior_scale": 0.05, "seasonality_prior_scale": 10.0, "holidays_prior_scale": 10.0,
    "seasonality_mode": "multiplicative", "changepoint_range": 0.90,
}
FIXED_ORDER = (2, 1, 1)
CURVE_HORIZONS = [1, 3, 7, 14, 30]
MINIMUM_ROWS = 60
QUANTILES = (0.1, 0.5, 0.9)




def design_row() -> Column:
    """A row of cross products: the design, then the target."""
    return F.array_append("x", F.col("target"))


def seasonal_forecast(
    daily: DataFrame, design: Design = Design(), horizon: int = 30, future: DataFrame | None = None,
    initial: int = 180, period: int = 30, minimum: int = MINIMUM_ROWS,
) -> DataFrame:
    """Forecast with a 90% interval for each day of the horizon, and rolling-origin errors.

    Rows without a quantity are left out; a SKU needs ``minimum`` rows. ``future`` holds the regressors
    that are known ahead (see `curves.future_days`). The errors are means over the test rows of all
    cutoffs; a SKU without a cutoff or without test rows has null errors.
    """
    points = stage_table(curves.series_points(daily, design, minimum), "curve-points")
    points = points.withColumn("target", design.target(F.col("y")))
    rows, cuts, tests = curves.rolling_tests(points, ["x"], horizon, period, initial)
    systems = curves.prefix_systems(rows.withColumn("row", design_row()), cuts, design.size + 1)
    spans = stage_table(cuts, "curve-cuts")
    seen = (F.col("end") - horizon - F.col("cut") * period - F.col("start")) / F.greatest(F.col("end") - F.col("start"), F.lit(1))
    share = F.when(F.col("cut") == curves.FULL, F.lit(1.0)).otherwise(seen)
    ridge = design.ridge(used=design.used_hinges(share))
    fits = stage_table(curves.solved(systems.join(spans, ["product_id", "cut"]), design.size, ridge), "curve-fits")
    measured = fits.filter(F.col("cut") >= 0).join(tests, ["product_id", "cut"]).select("product_id", F.inline(curves.test_errors(design)))
    scores = measured.groupBy("product_id").agg(
        F.avg("share").alias("mape"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"), F.avg("error").alias("mae"), F.avg("inside").alias("coverage")
    )
    full = fits.filter(F.col("cut") == curves.FULL)
    ahead = curves.future_days(full.select("product_id", "start", "end"), design, horizon, future)
    placed = ahead.join(full.select("product_id", "beta", "half"), "product_id").withColumn("_m", ln.dot(F.col("x"), F.col("beta")))
    bounds = {"yhat": F.col("_m"), "yhat_lower": F.col("_m") - F.col("half"), "yhat_upper": F.col("_m") + F.col("half")}
    out = placed.select("product_id", F.col("date").alias("ds"), *[design.back(v).alias(c) for c, v in bounds.items()])
    return out.join(scores, "product_id", "left")


def dual_season_forecast(daily: DataFrame, classes: DataFrame | None, horizon: int = 30, future: DataFrame | None = None) -> DataFrame:
    """Weekly and annual seasons with the regressors present, for SKUs classed high.

    Without a class table, or when no SKU is classed high, every SKU is forecast.
    """
    chosen = daily
    if classes is not None:
        high = classes.filter("category = 'high'").select("product_id")
        listed = high.agg(F.count(F.lit(1))).scalar() > 0
        chosen = daily.join(high.withColumn("_high", F.lit(True)).distinct(), "product_id", "left").filter(F.col("_high") | ~listed).drop("_high")
    names = tuple(c for c in ("is_promotional_period", "is_holiday", "temp_c", "cpi_index") if c in daily.columns)
    return seasonal_forecast(chosen, Design(regressors=names, log=True), horizon, future)


def error_by_horizon(daily: DataFrame, classes: DataFrame, horizons: Sequence[int] = tuple(CURVE_HORIZONS)) -> DataFrame:
    """Hold-out error of each SKU for each horizon: the last h rows against the fit to the rows before; too short series give null."""
    design = Design(weekly=3, yearly=3)
    back = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("day").desc()))
    points = curves.series_points(daily, design, 2).withColumns({"target": design.target(F.col("y")), "_b": back})
    points = stage_table(points, "horizon-points")
    steps = sorted(horizons)
    # A row is in the history of every horizon shorter than its distance from the end.
    passed = [F.when(F.col("_b") > h, F.lit(h)) for h in steps]
    cut = F.coalesce(F.greatest(*passed, F.lit(curves.FULL)), F.lit(curves.FULL)) if len(passed) else F.lit(curves.FULL)
    rows = points.withColumn("cut", cut).withColumn("row", design_row())
    spans = points.groupBy("product_id").agg(F.first("n").alias("n"), F.first("start").alias("start"), F.first("end").alias("end"))
    tasks = spans.select("*", F.explode(F.array(*[F.lit(h) for h in steps])).alias("cut"))
    able = tasks.filter(F.col("n") >= F.col("cut") + MINIMUM_ROWS)
    systems = curves.prefix_systems(rows, able, design.size + 1)
    fits = curves.solved(systems, design.size, design.ridge())
    open_to = F.filter(F.array(*[F.lit(h) for h in steps]), lambda h: h >= F.col("_b"))
    tests = points.select("product_id", F.struct("y", "x").alias("test"), F.explode(open_to).alias("cut")).groupBy("product_id", "cut").agg(F.collect_list("test").alias("tests"))
    errors = fits.join(tests, ["product_id", "cut"]).select("product_id", "cut", F.inline(curves.test_errors(design)))
    measured = errors.groupBy("product_id", "cut").agg(F.avg("share").alias("mape"))
    category = F.coalesce("category", F.lit("low"))
    tier = F.when(category == "high", "A").when(category == "moderate", "B").otherwise("C")
    named = tasks.join(classes.select("product_id", "category"), "product_id", "left").join(measured, ["product_id", "cut"], "left")
    return named.select("product_id", F.col("cut").alias("h"), tier.alias("tier"), "mape")


def tier_error_curve(errors: DataFrame) -> DataFrame:
    return errors.groupBy("tier", "h").agg(F.avg("mape").alias("mape"), F.count("mape").alias("n_skus"))


def stable_skus(errors: DataFrame, h: int = 14, limit: float = 0.10) -> DataFrame:
    return errors.filter((F.col("h") == h) & (F.col("mape") < limit)).select("product_id", "mape")


def parameter_grid() -> list[Column]:
    """One explode per parameter: the grid comes from literals, without a join."""
    return [F.explode(F.array(*[F.lit(v) for v in values])).alias(name) for name, values in SEARCH_SPACE.items()]


def with_grid(rows: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Every row with every combination of the named parameters (all by default)."""
    for column, name in zip(parameter_grid(), SEARCH_SPACE):
        if names is None or name in names:
            rows = rows.select("*", column)
    return rows


#: The curve of the search: 18 columns, and the promotion.
SEARCH_DESIGN = Design(weekly=3, yearly=3, hinges=4)


def search_parameters(daily: DataFrame, horizon: int = 30, period: int = 7, initial: int = 180) -> DataFrame:
    """Rolling-origin errors of all 640 parameter combinations for every SKU of ``MINIMUM_ROWS`` rows or more.

    Sums of cross products are taken once for both modes: the rows carry both targets. A cutoff has as
    many systems as it has trend and season scales and different numbers of usable hinges; the scale of
    the promotion column, which stands last, enters by one division each. A trial without a cutoff,
    or with a test value of zero, has failed and has no error.
    """
    names = tuple(c for c in ("is_promotional_period",) if c in daily.columns)
    design, inner = replace(SEARCH_DESIGN, regressors=names), SEARCH_DESIGN
    k, extra = inner.size, len(names)
    points = stage_table(curves.series_points(daily, design, MINIMUM_ROWS), "search-points")
    logged = F.log1p(F.greatest(F.col("y"), F.lit(0.0)))
    # The last numbers of a row: the promotion column, or a column of zeros without one, and both targets.
    last = F.concat(F.col("x") if extra else F.array_append("x", F.lit(0.0)), F.array(F.col("y"), logged))
    rows, cuts, tests = curves.rolling_tests(points.withColumn("row", last), ["row"], horizon, period, initial)
    skus = points.select("product_id").distinct()
    spans = stage_table(cuts.filter(F.col("cut") >= 0), "search-cuts")
    systems = curves.prefix_systems(rows, spans, k + 3).join(spans, ["product_id", "cut"]).join(tests, ["product_id", "cut"])
    systems = stage_table(systems, "search-systems")

    seen = (F.col("end") - horizon - F.col("cut") * period - F.col("start")) / F.greatest(F.col("end") - F.col("start"), F.lit(1))
    ranges = F.array(*[F.struct(F.lit(r).alias("range"), inner.used_hinges(seen, r).alias("used")) for r in SEARCH_SPACE["changepoint_range"]])
    used = F.array_distinct(F.transform("ranges", lambda r: r["used"]))
    opened = systems.withColumn("ranges", ranges).withColumn("used", F.explode(used))
    opened = opened.withColumn("ranges", F.transform(F.filter("ranges", lambda r: r["used"] == F.col("used")), lambda r: r["range"]))
    for name in ("changepoint_prior_scale", "seasonality_prior_scale"):
        opened = opened.withColumn(name, F.explode(F.array(*[F.lit(v) for v in SEARCH_SPACE[name]])))
    opened = spread(opened, "product_id", "cut", "used", "changepoint_prior_scale", "seasonality_prior_scale")

    at = lambda i, j: F.get(F.get("sums", F.lit(i)), F.lit(j))
    ridge = inner.ridge(F.col("changepoint_prior_scale"), F.col("seasonality_prior_scale"), 1.0, F.col("used"))
    solved = opened.withColumn("_ridge", ridge).withColumn("_l", ln.factor(F.slice("sums", 1, k), F.col("_ridge")))
    rights = {"_zp": k, "_za": k + 1, "_zm": k + 2}
    solved = solved.withColumns({c: ln.forward(F.col("_l"), F.slice(F.get("sums", F.lit(i)), 1, k)) for c, i in rights.items()})
    solved = solved.withColumns({c.replace("z", "b"): ln.backward(F.col("_l"), F.col(c)) for c in rights})
    free = F.size(F.filter("_ridge", lambda r: r < curves.BLOCKED)) + extra
    solved = solved.withColumns({"_free": free, "_open": at(k, k) - ln.dot(F.col("_zp"), F.col("_zp"))})
    scales = {"additive": ("_za", "_ba", k + 1), "multiplicative": ("_zm", "_bm", k + 2)}
    tried = [(f"{mode[0]}{i}", mode, scale) for mode in SEARCH_SPACE["seasonality_mode"] for i, scale in enumerate(SEARCH_SPACE["holidays_prior_scale"])]
    # The slope of the promotion column and half the interval of each mode and scale.
    crossed = {m: at(i, k) - ln.dot(F.col("_zp"), F.col(z)) for m, (z, _, i) in scales.items()}
    left = {m: at(i, i) - ln.dot(F.col(z), F.col(z)) for m, (z, _, i) in scales.items()}
    squares = {}
    for m, (_, b, _) in scales.items():
        weigh = lambda x, y: F.aggregate(F.zip_with("_ridge", F.zip_with(x, y, lambda p, q: p * q), lambda r, v: r * v), F.lit(0.0), lambda t, v: t + v)
        squares |= {f"_{m}_bb": weigh(b, b), f"_{m}_bp": weigh(b, "_bp")}
    squares["_pp"] = weigh("_bp", "_bp")
    solved = solved.withColumns({**{f"_{m}_c": c for m, c in crossed.items()}, **{f"_{m}_l": c for m, c in left.items()}, **squares})
    slopes, halves = {}, {}
    for name, mode, scale in tried:
        g, pivot = F.col(f"_{mode}_c") / (F.col("_open") + 1 / scale), F.col("_open") + 1 / scale
        held = F.col(f"_{mode}_bb") - 2 * g * F.col(f"_{mode}_bp") + g * g * F.col("_pp") + g * g / scale
        rest = F.greatest(F.col(f"_{mode}_l") - g * g * pivot - held, F.lit(0.0))
        slopes[f"_g_{name}"] = g
        halves[f"_h_{name}"] = F.sqrt(rest / F.greatest(F.col("n_train") - F.col("_free"), F.lit(1))) * curves.Z90
    grid = ["changepoint_prior_scale", "seasonality_prior_scale"]
    solved = solved.withColumns({**slopes, **halves}).select("product_id", "ranges", *grid, "_bp", "_ba", "_bm", *slopes, *halves, F.explode("tests").alias("t"))
    row, y = F.col("t.row"), F.col("t.y")
    base = {"additive": ln.fixed_dot(row, F.col("_ba"), k), "multiplicative": ln.fixed_dot(row, F.col("_bm"), k)}
    lines = solved.select("product_id", "ranges", *grid, *slopes, *halves, y.alias("_y"), *[v.alias(f"_{m}") for m, v in base.items()],
                          (F.get(row, F.lit(k)) - ln.fixed_dot(row, F.col("_bp"), k)).alias("_p"))
    sums = [F.count(F.lit(1)).alias("_n"), F.bool_or(F.abs("_y") < 1e-8).alias("_zero")]
    for name, mode, _ in tried:
        back = F.expm1 if mode == "multiplicative" else (lambda v: v)
        middle, half = F.col(f"_{mode}") + F.col(f"_g_{name}") * F.col("_p"), F.col(f"_h_{name}")
        error = F.abs(F.col("_y") - back(middle))
        inside = (F.col("_y") >= back(middle - half)) & (F.col("_y") <= back(middle + half))
        sums += [F.sum(error / curves.percent_base(F.col("_y"))).alias(f"_s_{name}"), F.sum(error * error).alias(f"_q_{name}"), F.sum(F.when(inside, 1.0).otherwise(0.0)).alias(f"_i_{name}")]
    found = lines.groupBy("product_id", *grid, "ranges").agg(*sums)
    cells = F.array(*[
        F.struct(F.lit(mode).alias("seasonality_mode"), F.lit(scale).alias("holidays_prior_scale"), F.col(f"_s_{name}").alias("_share"), F.col(f"_q_{name}").alias("_square"), F.col(f"_i_{name}").alias("_inside"))
        for name, mode, scale in tried
    ])
    each = found.select("product_id", *grid, "_n", "_zero", "ranges", F.inline(cells)).withColumn("changepoint_range", F.explode("ranges"))
    sums = each.groupBy("product_id", *SEARCH_SPACE).agg(*[F.sum(c).alias(c) for c in ("_share", "_square", "_inside", "_n")], F.bool_or("_zero").alias("_zero"))
    good = F.col("_n").isNotNull() & ~F.col("_zero")
    whole = with_grid(skus).join(sums, ["product_id", *SEARCH_SPACE], "left")
    return whole.select(
        "product_id", *SEARCH_SPACE, F.when(good, F.col("_share") / F.col("_n")).alias("cv_mape"), F.sqrt(F.col("_square") / F.col("_n")).alias("cv_rmse"),
        (F.col("_inside") / F.col("_n")).alias("cv_coverage"), F.when(good, "SUCCESS").otherwise("FAILED").alias("status"),
        F.concat_ws("/", *[F.col(c).cast("string") for c in ("product_id", *SEARCH_SPACE)]).alias("trial_id"),
    )


# Candidate orders (p, d, q, seasonal) of the automatic choice.
CANDIDATES = [(p, d, q, s) for p in (0, 1, 2) for d in (0, 1) for q in (0, 1, 2) for s in (0, 1) if p + q + s]
#: Lags of the long autoregression whose residuals stand in for the shocks.
LONG = 10


def lagged_series(daily: DataFrame, horizon: int) -> DataFrame:
    """Rows of (product_id, d, place, y, w, lags, is_test): the series (d = 0) and its difference (d = 1) with their last ``LONG`` values."""
    order = Window.partitionBy("product_id").orderBy("day")
    known = daily.filter(F.col("quantity").isNotNull()).select("product_id", F.unix_date("date").alias("day"), F.col("quantity").cast("double").alias("y"))
    placed = known.withColumns({"place": F.row_number().over(order) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy("product_id")), "_before": F.lag("y").over(order)})
    long = placed.filter(F.col("n") >= horizon + MINIMUM_ROWS)
    both = long.select("product_id", "place", "n", "y", F.inline(F.array(
        F.struct(F.lit(0).alias("d"), F.col("y").alias("w")), F.struct(F.lit(1).alias("d"), (F.col("y") - F.col("_before")).alias("w"))
    )))
    own = Window.partitionBy("product_id", "d").orderBy("place")
    return both.withColumn("lags", F.array(*[F.lag("w", k).over(own) for k in range(1, LONG + 1)])).withColumn("is_test", F.col("place") >= F.col("n") - horizon)


def order_systems(daily: DataFrame, horizon: int = 30) -> DataFrame:
    """One row per SKU and difference: ``sums`` over the common sample, and what a forecast starts from.

    The columns are 1, lags 1, 2 and 7 and shocks 1 and 2, then the value. Shocks are the residuals of a
    long autoregression, joined back to the rows: a first grouped regression. All orders are fitted on
    the same rows, those with two shocks behind them whether or not the series is differenced.
    """
    rows = stage_table(lagged_series(daily, horizon), "order-rows")
    train = rows.filter("NOT is_test")
    whole = train.filter(F.col("place") >= LONG + F.col("d")).withColumn("row", F.concat(F.array(F.lit(1.0)), F.col("lags"), F.array("w")))
    products = curves.cross_products(whole, ["product_id", "d"], LONG + 2).withColumnRenamed("n", "n_train")
    first = curves.solved(products, LONG + 1, F.array_repeat(F.lit(curves.FREE), LONG + 1))
    guess = ln.fixed_dot(F.concat(F.array(F.lit(1.0)), F.col("lags")), F.col("beta"), LONG + 1)
    shocks = train.join(first.select("product_id", "d", "beta"), ["product_id", "d"]).withColumn("e", F.when(F.col("place") >= LONG + F.col("d"), F.col("w") - guess))
    own = Window.partitionBy("product_id", "d").orderBy("place")
    lag = lambda k: F.get("lags", F.lit(k - 1))
    shocks = shocks.withColumns({"_e1": F.lag("e", 1).over(own), "_e2": F.lag("e", 2).over(own)})
    row = F.array(F.lit(1.0), lag(1), lag(2), lag(7), F.col("_e1"), F.col("_e2"), F.col("w"))
    shocks = stage_table(shocks, "order-shocks")
    sample = shocks.filter(F.col("place") >= LONG + 3).withColumn("row", row)
    sums = curves.cross_products(sample, ["product_id", "d"], 7).withColumnRenamed("n", "n_used")
    newest = F.struct("place", "y", F.array_prepend(F.slice("lags", 1, 6), F.col("w")).alias("w"), F.array("e", "_e1").alias("e"))
    ends = shocks.groupBy("product_id", "d").agg(F.max(newest).alias("last"))
    tests = rows.filter("is_test AND d = 0").groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("place", "y"))).alias("t"))
    return sums.join(ends, ["product_id", "d"]).join(tests.select("product_id", F.col("t.y").alias("actual")), "product_id")


def arima_trials(daily: DataFrame, hints: DataFrame | None, horizon: int = 30) -> DataFrame:
    """Hold-out error and AIC of the hinted order and of all candidates per SKU.

    Every order is a subset of the columns of one system of sums. A SKU without a hint has no trial of
    the hinted order.
    """
    systems = stage_table(order_systems(daily, horizon), "order-systems")
    p, _, q = FIXED_ORDER

    def columns(p: int, q: int, s: int) -> list[int]:
        return [0, *range(1, p + 1), *([3] if s else []), *range(4, 4 + q)]

    def candidate(kind: str, p: int, q: int, s: int) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(s).alias("s"), F.array(*[F.lit(c) for c in columns(p, q, s)]).alias("columns"))

    tried = F.array(*[candidate("auto_arima", p, q, s) for p, d, q, s in CANDIDATES if d == 0])
    trials = systems.select("*", F.inline(tried))
    if hints is not None:
        hinted = systems.join(hints.select("product_id", "d"), ["product_id", "d"], "left_semi")
        trials = trials.unionByName(hinted.select("*", F.inline(F.array(candidate("arima", p, q, 0)))))
    trials = spread(trials, "product_id", "d", "kind", "p", "q", "s")
    cell = lambda a, b: F.get(F.get("sums", F.greatest(a, b)), F.least(a, b))
    own = F.transform("columns", lambda c, i: F.transform(F.slice("columns", F.lit(1), i + 1), lambda b: cell(c, b)))
    right = F.transform("columns", lambda c: cell(F.lit(6), c))
    fitted = trials.withColumn("_l", ln.factor(own, F.array_repeat(F.lit(curves.FREE), 6))).withColumn("_z", ln.forward(F.col("_l"), right))
    n, k = F.col("n_used"), F.size("columns")
    spread_ = F.greatest((F.get(F.get("sums", F.lit(6)), F.lit(6)) - ln.dot(F.col("_z"), F.col("_z"))) / n, F.lit(1e-12))
    fitted = fitted.withColumns({"aic": n * F.log(spread_) + 2 * (k + 1), "_b": ln.backward(F.col("_l"), F.col("_z"))})
    # Coefficients at their full places, zero where the order has none.
    full = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda c: F.coalesce(F.get("_b", F.array_position("columns", c).cast("int") - 1), F.lit(0.0)))
    start = F.struct(F.col("last.w").alias("w"), F.col("last.e").alias("e"), F.col("last.y").alias("level"), ln.doubles().alias("out"))

    def step(s: Column, _: Column) -> Column:
        b = lambda i: F.get("_f", F.lit(i))
        w = lambda i: F.get(s["w"], F.lit(i - 1))
        value = b(0) + b(1) * w(1) + b(2) * w(2) + b(3) * w(7) + b(4) * F.get(s["e"], F.lit(0)) + b(5) * F.get(s["e"], F.lit(1))
        return ln.let(value, lambda v: ln.let(F.when(F.col("d") == 1, s["level"] + v).otherwise(v), lambda y: F.struct(
            F.array_prepend(F.slice(s["w"], 1, 6), v).alias("w"), F.array_prepend(F.slice(s["e"], 1, 1), F.lit(0.0)).alias("e"),
            y.alias("level"), F.array_append(s["out"], y).alias("out"),
        )))

    ahead = fitted.withColumn("_f", full).withColumn("forecast", F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)["out"])
    shares = F.zip_with("actual", "forecast", lambda y, f: F.abs(y - f) / curves.percent_base(y))
    mape = F.aggregate(shares, F.lit(0.0), lambda a, v: a + v) / F.lit(horizon)
    return ahead.select("product_id", "kind", "p", "d", "q", "s", F.col("n_used").alias("n"), "aic", mape.alias("mape"))


def seasonal_holdout(daily: DataFrame, horizon: int = 30) -> DataFrame:
    """Error of the multiplicative seasonal curve on the last ``horizon`` rows of each SKU."""
    design = Design(weekly=3, yearly=10, log=True)
    back = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("day").desc()))
    points = curves.series_points(daily, design, horizon + MINIMUM_ROWS).withColumns({"target": design.target(F.col("y")), "_b": back})
    points = stage_table(points, "holdout-points")
    rows = points.withColumn("cut", F.when(F.col("_b") > horizon, 0).otherwise(curves.FULL)).withColumn("row", design_row())
    systems = curves.prefix_systems(rows, points.select("product_id", F.lit(0).alias("cut")).distinct(), design.size + 1)
    tests = points.filter(F.col("_b") <= horizon).groupBy("product_id").agg(F.collect_list(F.struct("y", "x")).alias("tests"))
    errors = curves.solved(systems, design.size, design.ridge()).join(tests, "product_id").select("product_id", F.inline(curves.test_errors(design)))
    return errors.groupBy("product_id").agg(F.avg("share").alias("mape"))


def arima_benchmark(daily: DataFrame, hints: DataFrame | None = None, horizon: int = 30) -> DataFrame:
    """Per SKU the error of each method, the chosen order and the winner; a method that was not run has a null error."""
    usable = F.col("aic").isNotNull() & ~F.isnan("aic")
    best = arima_trials(daily, hints, horizon).groupBy("product_id", "kind").agg(F.min(F.when(usable, F.struct("aic", "p", "d", "q", "s", "mape"))).alias("b"))
    wide = best.groupBy("product_id").pivot("kind", ["arima", "auto_arima"]).agg(F.first("b"))
    wide = wide.join(seasonal_holdout(daily, horizon).withColumnRenamed("mape", "seasonal_mape"), "product_id", "left")
    order = F.format_string("(%d,%d,%d)x%d", *[F.col(f"auto_arima.{c}") for c in "pdqs"])
    errors = {"arima": F.col("arima.mape"), "seasonal": F.col("seasonal_mape"), "auto_arima": F.col("auto_arima.mape")}
    return wide.select(
        "product_id", *[e.alias(f"{k}_mape") for k, e in errors.items()], order.alias("auto_order"), winner_by_min(errors, "arima").alias("winner"),
    )


QUANTILE_DESIGN = Design(weekly=3, yearly=2, hinges=4)


def quantile_fits(points: DataFrame, design: Design, quantiles: Sequence[float] = QUANTILES, rounds: int = 8) -> DataFrame:
    """(product_id, quantile, beta): curves of least pinball loss, by iteratively reweighted grouped sums.

    A residual r weighs (q, or 1 - q below the curve) / |r|, so that the weighted square is the pinball
    loss; small residuals are held at a share of the mean deviation of the first fit that shrinks from
    round to round, so that no row keeps the curve to itself. Weights are divided by their mean, which
    keeps the ridge in proportion. A round adds up the weighted products of all rows.
    """
    keys, size = ["product_id", "quantile"], design.size
    each = points.select("product_id", F.explode(F.array(*[F.lit(q) for q in quantiles])).alias("quantile"), "x", "y")

    def fit(weighted: DataFrame) -> DataFrame:
        """``weighted``: keys, x, y and weight."""
        rows = weighted.withColumn("row", F.array_append("x", F.col("y")))
        # The ridge stands against weights of mean one.
        mean = weighted.groupBy(*keys).agg(F.avg("weight").alias("_mean"))
        sums = curves.cross_products(rows, keys, size + 1, "weight").join(mean, keys)
        ridge = F.transform(design.ridge(), lambda r: r * F.col("_mean"))
        lower = sums.withColumn("_low", ln.factor(F.slice("sums", 1, size), ridge))
        right = F.slice(F.get("sums", F.lit(size)), 1, size)
        return lower.select(*keys, ln.backward(F.col("_low"), ln.forward(F.col("_low"), right)).alias("beta"))

    first = stage_table(fit(each.withColumn("weight", F.lit(1.0))), "quantile-fit")
    rest = F.col("y") - ln.fixed_dot(F.col("x"), F.col("beta"), size)
    floor = each.join(first, keys).groupBy("product_id").agg(F.greatest(F.avg(F.abs(rest)), F.lit(1e-6)).alias("_floor"))
    floor, fits = stage_table(floor, "quantile-floor"), first
    for turn in range(rounds):
        side = F.when(F.col("_r") >= 0, F.col("quantile")).otherwise(1 - F.col("quantile"))
        residual = each.join(fits, keys).join(floor, "product_id").withColumn("_r", rest)
        weighted = residual.withColumn("weight", side / F.greatest(F.abs("_r"), F.col("_floor") * (0.5 * 0.6**turn)))
        fits = stage_table(fit(weighted.select(*keys, "x", "y", "weight")), "quantile-fit")
    return fits


def pinball(points: DataFrame, fits: DataFrame) -> DataFrame:
    """(product_id, quantile, loss, below): mean pinball loss of the curves and the share of rows below them."""
    r, q = F.col("y") - ln.dot(F.col("x"), F.col("beta")), F.col("quantile")
    loss = F.when(r >= 0, q * r).otherwise((q - 1) * r)
    return points.select("product_id", "x", "y").join(fits, "product_id").groupBy("product_id", "quantile").agg(
        F.avg(loss).alias("loss"), F.avg(F.when(r < 0, 1.0).otherwise(0.0)).alias("below")
    )


def quantile_forecast(daily: DataFrame, horizon: int = 90, design: Design = QUANTILE_DESIGN) -> DataFrame:
    """P10, P50 and P90 for each step from curves of least pinball loss; the band widens with the step.

    Curves that cross are put in order. No value is below 0.
    """
    points = stage_table(curves.series_points(daily, design, MINIMUM_ROWS), "quantile-points")
    fits = quantile_fits(points, design).groupBy("product_id").agg(F.sort_array(F.collect_list(F.struct("quantile", "beta"))).alias("fits"))
    spans = points.groupBy("product_id").agg(F.first("start").alias("start"), F.first("end").alias("end"))
    ahead = curves.future_days(spans, design, horizon).join(fits, "product_id")
    ordered = F.array_sort(F.transform("fits", lambda f: ln.dot(F.col("x"), f["beta"])))
    placed = ahead.withColumn("_q", ordered).withColumn("_wide", F.sqrt(1 + F.col("step") / 30.0))
    middle = F.get("_q", F.lit(1))
    value = lambda i: F.greatest(F.lit(0.0), middle + (F.get("_q", F.lit(i)) - middle) * F.col("_wide"))
    return placed.select("product_id", "step", "date", value(0).alias("p10"), value(1).alias("p50"), value(2).alias("p90"))


def residual_quantile_forecast(daily: DataFrame, horizon: int = 30, design: Design = Design(weekly=3, yearly=3)) -> DataFrame:
    """(product_id, date, p10, p50, p90): the least-squares curve moved by the quantiles of its residuals, which widen with the step; none below 0."""
    points = stage_table(curves.series_points(daily, design, MINIMUM_ROWS).withColumn("target", F.col("y")), "band-points")
    spans = points.groupBy("product_id").agg(F.first("start").alias("start"), F.first("end").alias("end"))
    marks = spans.select("product_id", F.lit(curves.FULL).alias("cut"))
    rows = points.select("product_id", F.lit(curves.FULL).alias("cut"), design_row().alias("row"))
    fits = curves.solved(curves.prefix_systems(rows, marks, design.size + 1), design.size, design.ridge()).select("product_id", "beta")
    rest = points.join(fits, "product_id").select("product_id", (F.col("y") - ln.fixed_dot(F.col("x"), F.col("beta"), design.size)).alias("r"))
    # A series has at most one row per calendar day.
    bands = rest.groupBy("product_id").agg(*[F.percentile("r", q).alias(f"_q{i}") for i, q in enumerate(QUANTILES)])
    ahead = curves.future_days(spans, design, horizon).join(fits, "product_id").join(bands, "product_id")
    wide, middle = F.sqrt(1 + F.col("step") / 30.0), ln.dot(F.col("x"), F.col("beta"))
    value = lambda i: F.greatest(F.lit(0.0), middle + F.col("_q1") + (F.col(f"_q{i}") - F.col("_q1")) * wide)
    return ahead.select("product_id", "date", value(0).alias("p10"), value(1).alias("p50"), value(2).alias("p90"))
