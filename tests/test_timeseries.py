import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.functions import series
from shelfline.functions.scalars import normal_cdf
from shelfline.operators import timeseries as ts
from shelfline.operators import unit_root

START = dt.date(2023, 1, 1)


def frame(spark, **named):
    data = [(k, START + dt.timedelta(days=i), float(v)) for k, values in named.items() for i, v in enumerate(values)]
    return spark.createDataFrame(data, "product_id string, date date, quantity double")


def noise(n=200, seed=42):
    return np.random.default_rng(seed).normal(size=n)


def sinusoid(n=350, amplitude=50.0, spread=0.5, seed=42):
    return 100 + amplitude * np.sin(2 * np.pi * np.arange(n) / 7) + np.random.default_rng(seed).normal(0, spread, n)


def test_stationarity_of_noise_and_walk(spark):
    walk = np.cumsum(noise(400, 3))
    got = {r["product_id"]: r for r in ts.stationarity(frame(spark, noise=noise(), walk=walk, short=noise(29))).collect()}
    assert set(got) == {"noise", "walk"}
    assert got["noise"]["adf_p"] < 0.05 and got["noise"]["is_stationary_kpss"] and not got["noise"]["recommend_differencing"]
    assert got["walk"]["adf_p"] > 0.05 and got["walk"]["recommend_differencing"] and got["walk"]["diff_is_stationary"]


def brute_tau(x):
    """The t statistic by separate least-squares fits of every lag count; also the lag count."""
    dx, n = np.diff(x), len(x)
    longest = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))

    def fit(lags, first):
        rows = np.arange(first, len(dx))
        a = np.column_stack([np.ones(len(rows)), x[rows], *[dx[rows - k] for k in range(1, lags + 1)]])
        beta = np.linalg.lstsq(a, dx[rows], rcond=None)[0]
        rest = dx[rows] - a @ beta
        return a, beta, rest @ rest

    def score(lags):
        a, _, ssr = fit(lags, longest)
        return len(a) * np.log(ssr / len(a)) + 2 * a.shape[1]

    best = min(range(longest + 1), key=score)
    a, beta, ssr = fit(best, best)
    return beta[1] / np.sqrt(ssr / (len(a) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1]), best


def test_unit_root_p_value_at_published_critical_values(spark):
    # 1%, 5% and 10% points of the test with constant for large samples.
    taus = [-3.43, -2.86, -2.57, -20.0, 3.0]
    got = spark.range(1).select(*[unit_root.unit_root_p(F.lit(t)).alias(str(t)) for t in taus]).first()
    assert list(got)[:3] == [pytest.approx(p, abs=2e-3) for p in (0.01, 0.05, 0.10)] and list(got)[3:] == [0.0, 1.0]


def test_normal_distribution_function(spark):
    z = [-9.0, -7.5, -3.0, -0.5, 0.0, 1.0, 7.9, 9.0]
    got = spark.range(1).select(*[normal_cdf(F.lit(v)).alias(str(v)) for v in z]).first()
    assert list(got) == [pytest.approx(0.5 * (1 + math.erf(v / math.sqrt(2))), abs=1e-13) for v in z]


def test_unit_root_statistic_matches_separate_regressions(spark):
    rng = np.random.default_rng(8)
    lengths = {"shortest": (30, 0.1), "odd": (31, 0.0), "walk": (45, 1.0), "mixed": (120, 0.3), "long": (900, 0.05)}
    named = {k: np.cumsum(rng.normal(size=n)) * s + rng.normal(size=n) + 1000 for k, (n, s) in lengths.items()}
    series = unit_root.level_and_change(frame(spark, **named), "quantity", 30)
    got = unit_root.statistics(unit_root.best_lags(unit_root.lag_sums(series, ["product_id", "d"], 21))).collect()
    assert len(got) == 10
    for r in got:
        x = named[r["product_id"]] if r["d"] == 0 else np.diff(named[r["product_id"]])
        tau, best = brute_tau(x)
        assert r["best"] == best and r["tau"] == pytest.approx(tau, rel=1e-7)


def test_unit_root_without_answer(spark):
    df = frame(spark, flat=np.ones(50), line=np.arange(50.0), short=noise(29)).withColumn("extra", F.lit(1))
    got = {r["product_id"]: (r["adf_p"], r["adf_diff_p"]) for r in ts.adf_test(df).collect()}
    assert got == {"flat": (None, None), "line": (None, None)}
    assert ts.adf_test(df.limit(0)).count() == 0


def test_kpss_matches_direct_formula(spark):
    x = np.cumsum(noise(150, 4)) * 0.2 + noise(150, 5)
    e, n = x - x.mean(), len(x)
    gamma = [e[k:] @ e[: n - k] for k in range(n)]
    window = int(n ** (2 / 9))
    s0 = gamma[0] / n + sum(2 * gamma[k] / n for k in range(1, window + 1))
    s1 = sum(2 * k * gamma[k] / n for k in range(1, window + 1))
    lags = int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))
    var = (gamma[0] + 2 * sum((1 - k / (lags + 1)) * gamma[k] for k in range(1, lags + 1))) / n
    got = ts.kpss_test(frame(spark, s=x)).first()
    assert got["lags"] == lags and got["kpss_stat"] == pytest.approx((np.cumsum(e) ** 2).sum() / n**2 / var)
    assert 0.01 <= got["kpss_p"] <= 0.1


def test_seasonal_strength_classes(spark):
    got = {r["product_id"]: (r["seasonal_strength"], r["category"]) for r in ts.strength_classes(
        frame(spark, wave=sinusoid(), noise=noise(300), short=noise(13))).collect()}
    assert set(got) == {"wave", "noise"}
    assert got["wave"][0] > 0.95 and got["wave"][1] == "high" and got["noise"][0] < 0.5


def test_decomposition_resists_an_outlier():
    y = sinusoid(140, spread=0.1)
    y[70] += 500
    season, trend = series.seasonal_trend(y)
    assert np.abs(season - 50 * np.sin(2 * np.pi * np.arange(140) / 7)).max() < 3
    assert np.abs(trend[60:80] - 100).max() < 3


def test_loess_reproduces_a_line():
    x = np.arange(20.0)
    np.testing.assert_allclose(series.loess(3 + 2 * x, 7, np.ones(20), np.arange(-1.0, 21)), 3 + 2 * np.arange(-1.0, 21))


def test_autocorrelations_of_an_ar1(spark):
    x = np.zeros(600)
    for i, e in enumerate(noise(600, 6)):
        x[i] = 0.7 * x[i - 1] + e
    df = frame(spark, s=x)
    acf = {r["lag"]: r for r in ts.autocorrelation(df, 10).collect()}
    c = x - x.mean()
    for k in range(11):
        assert acf[k]["acf"] == pytest.approx(c[k:] @ c[: len(c) - k] / (c @ c))
    assert acf[1]["half_width"] == pytest.approx(1.96 / np.sqrt(600))
    assert acf[2]["half_width"] == pytest.approx(1.96 * np.sqrt((1 + 2 * acf[1]["acf"] ** 2) / 600))
    pacf = {r["lag"]: r["pacf"] for r in ts.partial_autocorrelation(df).collect()}
    r = [acf[k]["acf"] for k in range(11)]
    for k in (1, 2, 5):
        system = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert pacf[k] == pytest.approx(np.linalg.solve(system, r[1 : k + 1])[-1])
    assert len(pacf) == 30


def test_short_series_limit_lags(spark):
    df = frame(spark, s=noise(12))
    assert max(r["lag"] for r in ts.autocorrelation(df).collect()) == 10
    assert max(r["lag"] for r in ts.partial_autocorrelation(df).collect()) == 5


def test_spectrum(spark):
    t = np.arange(800)
    both = 10 * np.sin(2 * np.pi * t / 7) + 10 * np.sin(2 * np.pi * t / 365) + noise(800)
    got = {r["product_id"]: (r["weekly"], r["annual"], r["dual"]) for r in ts.dual_seasonality(
        frame(spark, both=both, week=sinusoid(400), short=noise(29))).collect()}
    assert got == {"both": (True, True, True), "week": (True, False, False)}


def test_sliding_windows_and_scaling(spark):
    df = frame(spark, s=np.arange(60.0), short=np.arange(57.0))
    got = ts.sliding_windows(df).orderBy("date").collect()
    assert len(got) == 3 and got[0]["x"] == list(range(28)) and got[0]["y"] == list(range(28, 58))
    z = ts.train_only_zscore(df).orderBy("date").collect()
    assert {r["product_id"] for r in z} == {"s"} and sum(r["in_train"] for r in z) == 2 + 57
    assert z[0]["train_mean"] == pytest.approx(np.mean(np.arange(59))) and z[0]["train_std"] == pytest.approx(np.std(np.arange(59)) + 1e-8)


def test_holdout_and_cutoffs(spark):
    df = frame(spark, s=np.arange(90.0), short=np.arange(89.0))
    split = ts.holdout_split(df)
    assert split.filter("is_test").count() == 30 and split.count() == 90
    long = frame(spark, s=np.arange(300.0), tiny=np.arange(200.0))
    cuts = [r["cutoff"] for r in ts.rolling_cutoffs(long).orderBy(F.desc("cutoff")).collect()]
    end = START + dt.timedelta(days=299)
    assert cuts == [end - dt.timedelta(days=30 + 30 * k) for k in range(3)]


@pytest.mark.parametrize("period", [7, 30, 45])
def test_cutoff_sizes_match_brute_force(spark, period):
    days = sorted(np.random.default_rng(1).choice(400, 260, replace=False).tolist())
    df = spark.createDataFrame([("s", START + dt.timedelta(days=d), 1.0) for d in days], "product_id string, date date, quantity double")
    got = ts.cutoff_sizes(df, ts.rolling_cutoffs(df, period=period), period=period).collect()
    assert len(got) > 3
    for r in got:
        c = (r["cutoff"] - START).days
        assert r["n_train"] == sum(d <= c for d in days) and r["n_test"] == sum(c < d <= c + 30 for d in days)


def test_differencing_and_analysis_series(spark):
    df = frame(spark, a=[1.0, 4.0, 9.0])
    assert [r["diff"] for r in ts.differenced(df).orderBy("date").collect()] == [3.0, 5.0]
    flags = spark.createDataFrame([("a", True)], "product_id string, recommend_differencing boolean")
    assert ts.analysis_series(df, flags).count() == 2
    assert ts.analysis_series(df, flags.withColumn("recommend_differencing", F.lit(False))).count() == 3
