"""Per-SKU time-series operators on daily sales.

Input has one row per SKU and day, so a SKU never holds more rows than the calendar has days;
windows and arrays per SKU are bounded by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.functions import linear
from shelfline.functions import series as kernels
from shelfline.functions.scalars import ladder
from shelfline.operators import unit_root
from shelfline.session import spread

# KPSS critical values with their p-values.
KPSS_CRITICAL = [0.347, 0.463, 0.574, 0.739]
KPSS_P = [0.10, 0.05, 0.025, 0.01]
MIN_TEST, MIN_DECOMPOSE, MIN_ORDER = 30, 14, 65
SEQUENCE, HORIZON = 28, 30


def _ordered(key="product_id", date="date"):
    return Window.partitionBy(key).orderBy(date)


def series_arrays(daily: DataFrame, key="product_id", date="date", value="quantity") -> DataFrame:
    """One row per SKU: days and values in order."""
    points = F.array_sort(F.collect_list(F.struct(F.col(date).alias("d"), F.col(value).cast("double").alias("v"))))
    rows = spread(daily.filter(F.col(value).isNotNull()), key).groupBy(key).agg(points.alias("_p"))
    return rows.select(
        key, F.size("_p").alias("n"), F.transform("_p", lambda p: p["d"]).alias("days"),
        F.transform("_p", lambda p: p["v"]).alias("values"),
    )


def differenced(daily: DataFrame) -> DataFrame:
    """First difference (first row dropped) and log1p."""
    out = daily.withColumns(
        {"diff": F.col("quantity") - F.lag("quantity").over(_ordered()), "log1p": F.log1p("quantity")}
    )
    return out.filter(F.col("diff").isNotNull())


def sliding_windows(daily: DataFrame, length: int = SEQUENCE, horizon: int = HORIZON) -> DataFrame:
    """Input and target sequences starting at every row that has enough rows after it."""
    whole = length + horizon
    ahead = _ordered().rowsBetween(0, whole - 1)
    rows = daily.withColumn("_w", F.collect_list(F.col("quantity").cast("double")).over(ahead))
    kept = rows.filter(F.size("_w") == whole)
    return kept.select(
        "product_id", "date", F.slice("_w", 1, length).alias("x"), F.slice("_w", length + 1, horizon).alias("y")
    )


def train_only_zscore(daily: DataFrame, length: int = SEQUENCE, horizon: int = HORIZON, share: float = 0.8) -> DataFrame:
    """Normalise with mean and deviation of the rows that the training windows cover."""
    whole = Window.partitionBy("product_id")
    extra = length + horizon - 1
    placed = daily.withColumns({"_i": F.row_number().over(_ordered()), "_n": F.count(F.lit(1)).over(whole)})
    windows = F.col("_n") - extra
    n_train = F.greatest(F.lit(1), F.floor(windows * F.lit(share)))
    inside = F.when((F.col("_i") <= n_train + extra), F.col("quantity"))
    out = placed.filter(windows > 0).withColumns(
        {"train_mean": F.avg(inside).over(whole), "train_std": F.stddev_pop(inside).over(whole) + F.lit(1e-8)}
    )
    z = (F.col("quantity") - F.col("train_mean")) / F.col("train_std")
    return out.withColumns({"z": z, "in_train": F.col("_i") <= n_train + extra}).drop("_i", "_n")


def holdout_split(daily: DataFrame, horizon: int = HORIZON, minimum: int = 60) -> DataFrame:
    """Last ``horizon`` rows per SKU are the test; SKUs with fewer than horizon + minimum rows are skipped."""
    back = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("date").desc()))
    n = F.count(F.lit(1)).over(Window.partitionBy("product_id"))
    placed = daily.withColumns({"_b": back, "_n": n}).filter(F.col("_n") >= horizon + minimum)
    return placed.withColumn("is_test", F.col("_b") <= horizon).drop("_b", "_n")


def rolling_cutoffs(daily: DataFrame, initial: int = 180, period: int = 30, horizon: int = HORIZON) -> DataFrame:
    """Cutoff days from end − horizon back by ``period`` while ``initial`` days of history remain."""
    span = daily.groupBy("product_id").agg(F.min("date").alias("_a"), F.max("date").alias("_b"))
    last, first = F.date_sub("_b", horizon), F.date_add("_a", initial)
    steps = F.when(last >= first, F.sequence(F.lit(0), F.floor(F.datediff(last, first) / period).cast("int")))
    return span.select("product_id", last.alias("_last"), F.explode(steps).alias("_s")).select(
        "product_id", F.date_sub("_last", (F.col("_s") * period).cast("int")).alias("cutoff")
    )


def cutoff_sizes(daily: DataFrame, cutoffs: DataFrame, period: int = 30, horizon: int = HORIZON) -> DataFrame:
    """Training and test rows of every cutoff, without pairing each row with each cutoff.

    Training sizes are a running count over rows and cutoffs in date order. A row lies in the
    test span of at most horizon/period cutoffs, so it is copied that often.
    """
    rows = daily.select("product_id", F.col("date").alias("at"), F.lit(1).alias("n"))
    marks = cutoffs.select("product_id", F.col("cutoff").alias("at"), F.lit(0).alias("n"))
    upto = Window.partitionBy("product_id").orderBy("at", F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    train = rows.unionByName(marks).withColumn("n_train", F.sum("n").over(upto)).filter("n = 0")
    last = cutoffs.groupBy("product_id").agg(F.max("cutoff").alias("_last"), F.min("cutoff").alias("_first"))
    behind = F.datediff("_last", "at")
    near = F.greatest(F.ceil((behind + 1) / period), F.lit(0)).cast("int")
    far = F.floor((behind + horizon) / period).cast("int")
    steps = F.when(far >= near, F.sequence(near, far))
    tested = rows.join(last, "product_id").select("product_id", "_last", "_first", F.explode(steps).alias("_s"))
    hit = tested.select("product_id", "_first", F.date_sub("_last", (F.col("_s") * period).cast("int")).alias("at"))
    counts = hit.filter(F.col("at") >= F.col("_first")).groupBy("product_id", "at").agg(F.count(F.lit(1)).alias("n_test"))
    return train.join(counts, ["product_id", "at"], "left").select(
        "product_id", F.col("at").alias("cutoff"), "n_train", F.coalesce("n_test", F.lit(0)).alias("n_test")
    )


def lag_products(daily: DataFrame, lags: int, value: str = "quantity") -> DataFrame:
    """Per SKU: size, and sums of centred products at lags 0 … ``lags`` as one array."""
    mean = F.avg(value).over(Window.partitionBy("product_id"))
    centred = daily.filter(F.col(value).isNotNull()).withColumn("_c", F.col(value) - mean)
    spec = _ordered()
    shifted = centred.select("product_id", "_c", *[F.lag("_c", k).over(spec).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = [F.sum(F.col("_c") * F.col("_c"))] + [F.sum(F.col("_c") * F.col(f"_l{k}")) for k in range(1, lags + 1)]
    return shifted.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.transform(F.array(*sums), lambda s: F.coalesce(s, F.lit(0.0))).alias("products")
    )


def autocorrelation(daily: DataFrame, lags: int = 60, value: str = "quantity") -> DataFrame:
    """Autocorrelations with their Bartlett 95% half-width; lags stop two short of the series length."""
    r = F.transform("products", lambda s: F.try_divide(s, F.element_at("products", 1)))
    rows = lag_products(daily, lags, value).select("product_id", "n", r.alias("r"))
    points = rows.select("product_id", "n", "r", F.posexplode("r").alias("lag", "acf")).filter(
        F.col("lag") <= F.least(F.lit(lags), F.col("n") - 2)
    )
    earlier = F.aggregate(
        F.when(F.col("lag") > 1, F.slice("r", F.lit(2), F.col("lag") - 1)).otherwise(F.array().cast("array<double>")),
        F.lit(0.0), lambda a, v: a + v * v,
    )
    half = F.when(F.col("lag") > 0, F.lit(1.96) * F.sqrt((1 + 2 * earlier) / F.col("n"))).otherwise(0.0)
    return points.select("product_id", "lag", "acf", half.alias("half_width"))


def partial_autocorrelation(daily: DataFrame, value: str = "quantity", lags: int = 30) -> DataFrame:
    """Yule–Walker partial autocorrelations with the constant 95% band."""
    rows = lag_products(daily, lags, value)
    r = F.transform("products", lambda s: F.coalesce(F.try_divide(s, F.element_at("products", 1)), F.lit(0.0)))
    kept = rows.select("product_id", "n", F.slice(r, F.lit(1), F.least(F.lit(lags), F.floor(F.col("n") / 2) - 1).cast("int") + 1).alias("r"))
    points = kept.select("product_id", "n", F.posexplode(linear.durbin_levinson(F.col("r"))).alias("_i", "pacf"))
    return points.select("product_id", (F.col("_i") + 1).alias("lag"), "pacf", (F.lit(1.96) / F.sqrt("n")).alias("half_width"))


def seasonal_means(daily: DataFrame) -> DataFrame:
    """Classical decomposition: centred 7-row trend, mean deviation per weekday, remainder."""
    frame = _ordered().rowsBetween(-3, 3)
    trend = F.when(F.count("quantity").over(frame) == 7, F.avg("quantity").over(frame))
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), F.col("date")).cast("int")
    rows = daily.withColumns({"trend": trend, "weekday": weekday})
    seasonal = F.avg(F.col("quantity") - F.col("trend")).over(Window.partitionBy("product_id", "weekday"))
    out = rows.withColumn("seasonal", seasonal)
    return out.withColumn("residual", F.col("quantity") - F.col("trend") - F.col("seasonal"))


def seasonal_summary(parts: DataFrame) -> DataFrame:
    known = parts.filter(F.col("trend").isNotNull())
    return known.groupBy("product_id").agg(
        (F.max_by("trend", "date") > F.min_by("trend", "date")).alias("trend_up"),
        F.stddev_samp("seasonal").alias("seasonal_std"), F.stddev_samp("residual").alias("residual_std"),
    )


def adf_test(daily: DataFrame) -> DataFrame:
    """Unit-root test of each series and of its first difference (30 rows or more)."""
    tested = unit_root.adf(daily, minimum=MIN_TEST)
    return tested.withColumns({"is_stationary_adf": F.col("adf_p") < 0.05, "diff_is_stationary": F.col("adf_diff_p") < 0.05})


def kpss_test(daily: DataFrame) -> DataFrame:
    """Level stationarity with the automatic lag rule (30 rows or more)."""
    rows = series_arrays(daily).filter(F.col("n") >= MIN_TEST)
    n = F.col("n")

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda a, v: a + v)

    def product(k: Column) -> Column:
        left, right = F.slice("c", k + 1, n - k), F.slice("c", F.lit(1), n - k)
        return total(F.zip_with(left, right, lambda x, y: x * y))

    def weighted(upto: Column, weight) -> Column:
        lags = F.when(upto > 0, F.sequence(F.lit(1), upto)).otherwise(F.array().cast("array<int>"))
        return total(F.transform(lags, lambda k: weight(k) * product(k)))

    centred = rows.withColumn("_m", total(F.col("values")) / n).withColumn(
        "c", F.transform("values", lambda v: v - F.col("_m"))
    )
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))
    climb = F.aggregate(
        "c", start, lambda a, v: F.struct((a["s"] + v).alias("s"), (a["q"] + (a["s"] + v) * (a["s"] + v)).alias("q"))
    )
    window = F.floor(F.pow(n, F.lit(2 / 9))).cast("int")
    base = centred.withColumns({"eta": climb["q"] / (n * n), "g0": product(F.lit(0)), "_w": window}).withColumns(
        {"_s0": (F.col("g0") + 2 * weighted(F.col("_w"), lambda k: F.lit(1.0))) / n,
         "_s1": 2 * weighted(F.col("_w"), lambda k: k.cast("double")) / n}
    )
    ratio = F.try_divide("_s1", "_s0")
    auto = F.floor(F.lit(1.1447) * F.pow(ratio * ratio, F.lit(1 / 3)) * F.pow(n, F.lit(1 / 3))).cast("int")
    placed = base.withColumn("lags", F.least(F.coalesce(auto, F.lit(0)), n - 1))
    lags, value = F.col("lags"), F.col("kpss_stat")
    variance = (F.col("g0") + 2 * weighted(lags, lambda k: 1 - k / (lags + 1))) / n
    p_value = F.when(value <= KPSS_CRITICAL[0], KPSS_P[0])
    for (c0, c1), (p0, p1) in zip(zip(KPSS_CRITICAL, KPSS_CRITICAL[1:]), zip(KPSS_P, KPSS_P[1:])):
        p_value = p_value.when(value <= c1, p0 + (value - c0) * ((p1 - p0) / (c1 - c0)))
    p_value = F.when(value.isNull(), 0.5).otherwise(p_value.otherwise(KPSS_P[-1]))
    return (
        placed.withColumn("kpss_stat", F.try_divide(F.col("eta"), variance))
        .withColumn("kpss_p", p_value)
        .select("product_id", "lags", "kpss_stat", "kpss_p", (F.col("kpss_p") > 0.05).alias("is_stationary_kpss"))
    )


def stationarity(daily: DataFrame) -> DataFrame:
    """Both tests; differencing is recommended when either fails."""
    both = adf_test(daily).join(kpss_test(daily), "product_id")
    return both.withColumn("recommend_differencing", ~F.col("is_stationary_adf") | ~F.col("is_stationary_kpss"))


def strength_classes(daily: DataFrame) -> DataFrame:
    s = F.col("seasonal_strength")
    rows = series_arrays(daily).filter(F.col("n") >= MIN_DECOMPOSE)
    scored = rows.select("product_id", kernels.seasonal_strength("values").alias("seasonal_strength"))
    return scored.withColumn("category", ladder([(s > 0.6, "high"), (s >= 0.3, "moderate")], "low"))


def order_hints(tests: DataFrame) -> DataFrame:
    """Fixed orders p = 2 and q = 1; one difference where recommended (65 rows or more)."""
    d = F.col("recommend_differencing").cast("int")
    return tests.filter(F.col("n") >= MIN_ORDER).select(
        "product_id", F.lit(2).alias("p"), d.alias("d"), F.lit(1).alias("q")
    )


def analysis_series(daily: DataFrame, tests: DataFrame) -> DataFrame:
    """The series each SKU is analysed on: its difference where recommended, else itself."""
    change = F.col("quantity") - F.lag("quantity").over(_ordered())
    flagged = daily.withColumn("_d", change).join(tests.select("product_id", "recommend_differencing"), "product_id")
    value = F.when(F.col("recommend_differencing"), F.col("_d")).otherwise(F.col("quantity"))
    return flagged.select("product_id", "date", value.alias("quantity")).filter(F.col("quantity").isNotNull())


def dual_seasonality(daily: DataFrame) -> DataFrame:
    rows = series_arrays(daily).filter(F.col("n") >= MIN_TEST)
    flags = rows.select("product_id", kernels.spectral_flags("values").alias("f"))
    return flags.select("product_id", "f.weekly", "f.annual", (F.col("f.weekly") & F.col("f.annual")).alias("dual"))
