"""Forecasting against plain numpy refits: every cutoff, every trial and every order is fitted anew here."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.functions import linear as ln
from shelfline.operators import curves
from shelfline.operators import forecast as fc
from shelfline.operators.curves import Design

START = dt.date(2023, 1, 1)
EPOCH = (START - dt.date(1970, 1, 1)).days


def frame(spark, **named):
    data = [(k, START + dt.timedelta(days=i), None if v is None else float(v)) for k, values in named.items() for i, v in enumerate(values)]
    return spark.createDataFrame(data, "product_id string, date date, quantity double")


def weekly(n=400, base=100.0, seed=0):
    return np.maximum(1, base + 15 * np.sin(2 * np.pi * np.arange(n) / 7) + np.random.default_rng(seed).normal(0, 3, n))


def rows_of(design, days, start, end, extra=()):
    u = (days - start) / max(end - start, 1)
    out = [np.ones(len(days)), u, *[np.maximum(0, u - k) for k in design.knots]]
    for period, order in ((curves.WEEK, design.weekly), (curves.YEAR, design.yearly)):
        for k in range(1, order + 1):
            out += [np.sin(days * (2 * np.pi * k / period)), np.cos(days * (2 * np.pi * k / period))]
    return np.column_stack([*out, *extra])


def ridge_of(design, trend=0.05, season=10.0, extra=10.0, reach=0.8, seen=1.0):
    hinges = [1 / trend if k <= reach * seen else curves.BLOCKED for k in design.knots]
    return np.array([curves.FREE] * 2 + hinges + [1 / season] * (2 * (design.weekly + design.yearly)) + [1 / extra] * len(design.regressors))


def refit(x, y, ridge):
    beta = np.linalg.solve(x.T @ x + np.diag(ridge), x.T @ y)
    free = int((ridge < curves.BLOCKED).sum())
    sigma = np.sqrt(((y - x @ beta) ** 2).sum() / max(len(y) - free, 1))
    return beta, sigma, free


def base(y):
    return np.where(np.abs(y) < 1e-8, 1.0, np.abs(y))


def test_systems_in_columns(spark):
    r = np.random.default_rng(1)
    data = []
    for k in range(20):
        x = r.normal(size=(40, 7))
        if k % 4 == 0:
            x[:, 5] = x[:, 1] - 2 * x[:, 3]  # depends on earlier columns
        a, b = x.T @ x, x.T @ r.normal(size=40)
        data.append((k, [[float(a[i, j]) for j in range(i + 1)] for i in range(7)], [float(v) for v in b], [0.5] * 7))
    df = spark.createDataFrame(data, "k int, a array<array<double>>, b array<double>, r array<double>")
    low = df.withColumn("plain", ln.factor(F.col("a"))).withColumn("held", ln.factor(F.col("a"), F.col("r")))
    got = low.select("k", *[ln.backward(F.col(c), ln.forward(F.col(c), F.col("b"))).alias(c) for c in ("plain", "held")], ln.fixed_dot(F.col("b"), F.col("r"), 7).alias("d")).collect()
    for row in got:
        _, a, b, ridge = data[row.k]
        full = np.array([[a[max(i, j)][min(i, j)] for j in range(7)] for i in range(7)])
        np.testing.assert_allclose(row.held, np.linalg.solve(full + np.diag(ridge), b), rtol=1e-9)
        keep = [i for i in range(7) if row.k % 4 or i != 5]
        want = np.zeros(7)
        want[keep] = np.linalg.solve(full[np.ix_(keep, keep)], np.array(b)[keep])
        np.testing.assert_allclose(row.plain, want, rtol=1e-6, atol=1e-9)
        assert row.d == pytest.approx(0.5 * sum(b))


@pytest.mark.parametrize("log", [False, True])
def test_every_cutoff_equals_a_refit(spark, log):
    r = np.random.default_rng(3)
    days = np.sort(r.choice(420, 330, replace=False))
    y = np.maximum(weekly(420)[days] + 5 * (days % 10 < 3), 0)
    promo = (days % 10 < 3).astype(float)
    df = spark.createDataFrame([("s", START + dt.timedelta(days=int(d)), float(v), bool(p)) for d, v, p in zip(days, y, promo)], "product_id string, date date, quantity double, promo boolean")
    design = Design(yearly=2, regressors=("promo",), log=log)
    known = spark.createDataFrame([(START + dt.timedelta(days=d), d % 10 < 3) for d in range(300, 440)], "date date, promo boolean")
    got = fc.seasonal_forecast(df, design, future=known, horizon=20).orderBy("ds").collect()
    t = days + EPOCH
    fwd, back = (np.log1p, np.expm1) if log else (lambda v: v, lambda v: v)
    cut, errors, inside = t[-1] - 20, [], []
    while cut >= t[0] + 180:
        train, test = t <= cut, (t > cut) & (t <= cut + 20)
        ridge = ridge_of(design, seen=(cut - t[0]) / (t[-1] - t[0]))
        beta, sigma, free = refit(rows_of(design, t[train], t[0], t[-1], [promo[train]]), fwd(y[train]), ridge)
        middle = rows_of(design, t[test], t[0], t[-1], [promo[test]]) @ beta
        half = curves.Z90 * sigma * np.sqrt(1 + free / train.sum())
        errors.append(np.column_stack([np.abs(y[test] - back(middle)), base(y[test])]))
        inside += list((y[test] >= back(middle - half)) & (y[test] <= back(middle + half)))
        cut -= 30
    e = np.concatenate(errors)
    assert got[0].mape == pytest.approx((e[:, 0] / e[:, 1]).mean()) and got[0].mae == pytest.approx(e[:, 0].mean())
    assert got[0].rmse == pytest.approx(np.sqrt((e[:, 0] ** 2).mean())) and got[0].coverage == pytest.approx(np.mean(inside))
    ahead = t[-1] + np.arange(1, 21)
    beta, sigma, free = refit(rows_of(design, t, t[0], t[-1], [promo]), fwd(y), ridge_of(design))
    middle = rows_of(design, ahead, t[0], t[-1], [((ahead - EPOCH) % 10 < 3).astype(float)]) @ beta
    half = curves.Z90 * sigma * np.sqrt(1 + free / len(t))
    np.testing.assert_allclose([g.yhat for g in got], back(middle), rtol=1e-6)
    np.testing.assert_allclose([g.yhat_lower for g in got], back(middle - half), rtol=1e-6)


def test_promotion_that_is_known_ahead_moves_the_forecast(spark):
    df = frame(spark, s=weekly(300) * (1 + (np.arange(300) % 10 < 3))).withColumn("promo", (F.datediff("date", F.lit(START)) % 10) < 3)
    design = Design(yearly=0, regressors=("promo",), log=True)
    day = spark.createDataFrame([(START + dt.timedelta(days=d), True) for d in (303, 304)], "date date, promo boolean")
    got = {r.ds: r.yhat for r in fc.seasonal_forecast(df, design, future=day).collect()}
    without = {r.ds: r.yhat for r in fc.seasonal_forecast(df, design).collect()}
    for d in (303, 304):
        assert got[START + dt.timedelta(days=d)] > 1.7 * without[START + dt.timedelta(days=d)]
    assert got[START + dt.timedelta(days=305)] == pytest.approx(without[START + dt.timedelta(days=305)])


def test_series_without_cutoffs_have_no_errors(spark):
    df = frame(spark, long=weekly(260), short=weekly(150), tiny=weekly(59), holes=[None] * 100 + list(weekly(70)))
    got = {r.product_id: r for r in fc.seasonal_forecast(df, Design(yearly=0)).collect()}
    assert set(got) == {"long", "short", "holes"}
    assert got["long"].mape < 0.1 and got["short"].mape is None and got["holes"].coverage is None and got["short"].yhat > 0
    assert fc.seasonal_forecast(df.limit(0)).count() == 0


def test_dual_season_uses_only_high_classes(spark):
    df = frame(spark, a=weekly(100), b=weekly(100))
    classes = spark.createDataFrame([("a", "high"), ("b", "low")], "product_id string, category string")
    assert {r[0] for r in fc.dual_season_forecast(df, classes, 5).select("product_id").collect()} == {"a"}
    assert fc.dual_season_forecast(df, None, 5).count() == 10 and fc.dual_season_forecast(df, classes.limit(0), 5).count() == 10


def test_trials_equal_refits(spark):
    y = weekly(235, seed=4) + 20 * (np.arange(235) % 10 < 3)
    df = frame(spark, s=y, short=weekly(150), zero=np.r_[y[:-1], 0.0]).withColumn("is_promotional_period", (F.datediff("date", F.lit(START)) % 10) < 3)
    trials = fc.search_parameters(df).collect()
    by = {}
    for r in trials:
        by.setdefault(r.product_id, []).append(r)
    assert all(len(v) == 640 and len({r.trial_id for r in v}) == 640 for v in by.values())
    assert {r.status for r in by["s"]} == {"SUCCESS"} and {r.status for r in by["short"]} == {r.status for r in by["zero"]} == {"FAILED"}
    assert all(r.cv_mape is None for r in by["short"] + by["zero"])
    t, promo = np.arange(235) + EPOCH, (np.arange(235) % 10 < 3).astype(float)
    design = fc.SEARCH_DESIGN
    full = Design(weekly=3, yearly=3, hinges=4, regressors=("is_promotional_period",))
    x = rows_of(design, t, t[0], t[-1], [promo])
    for r in by["s"][::41]:
        log = r.seasonality_mode == "multiplicative"
        cut, share, square, inside = t[-1] - 30, [], [], []
        while cut >= t[0] + 180:
            train, test = t <= cut, (t > cut) & (t <= cut + 30)
            ridge = ridge_of(full, r.changepoint_prior_scale, r.seasonality_prior_scale, r.holidays_prior_scale, r.changepoint_range, (cut - t[0]) / (t[-1] - t[0]))
            beta, sigma, _ = refit(x[train], np.log1p(y[train]) if log else y[train], ridge)
            middle, half = x[test] @ beta, curves.Z90 * sigma
            value, low, high = (np.expm1(v) if log else v for v in (middle, middle - half, middle + half))
            share += list(np.abs(y[test] - value) / y[test])
            square += list((y[test] - value) ** 2)
            inside += list((y[test] >= low) & (y[test] <= high))
            cut -= 7
        assert (r.cv_mape, r.cv_rmse, r.cv_coverage) == pytest.approx((np.mean(share), np.sqrt(np.mean(square)), np.mean(inside)), rel=1e-6)


def test_grid_size(spark):
    assert fc.with_grid(spark.range(2)).count() == 1280


def test_error_by_horizon(spark):
    classes = spark.createDataFrame([("s", "high")], "product_id string, category string")
    y = weekly(70)
    errors = fc.error_by_horizon(frame(spark, s=y, other=weekly(100)), classes)
    got = {(r["product_id"], r["h"]): (r["tier"], r["mape"]) for r in errors.collect()}
    assert got[("s", 14)] == ("A", None) and got[("s", 30)] == ("A", None) and got[("other", 30)][0] == "C" and len(got) == 10
    design, t = Design(weekly=3, yearly=3), np.arange(70) + EPOCH
    x = rows_of(design, t, t[0], t[-1])
    beta, *_ = refit(x[:-7], y[:-7], ridge_of(design))
    assert got[("s", 7)][1] == pytest.approx(np.mean(np.abs(y[-7:] - x[-7:] @ beta) / y[-7:]), rel=1e-4)
    assert {r["product_id"] for r in fc.stable_skus(errors).collect()} <= {"other"}
    assert fc.tier_error_curve(errors).filter("tier = 'A' AND h = 30").first()["mape"] is None


def order_brute(y, p, d, q, s, horizon):
    """(aic, n, forecast) of one order, rows in plain loops."""
    train = y[: len(y) - horizon]
    w = np.diff(train) if d else train
    at = np.arange(fc.LONG, len(w))
    long = np.column_stack([np.ones(len(at)), *[w[at - k] for k in range(1, fc.LONG + 1)]])
    e = np.full(len(w), np.nan)
    e[fc.LONG :] = w[fc.LONG :] - long @ np.linalg.lstsq(long, w[fc.LONG :], rcond=None)[0]
    at = np.arange(fc.LONG + 3 - d, len(w))
    columns = [np.ones(len(at)), *[w[at - k] for k in range(1, p + 1)], *([w[at - 7]] if s else []), *[e[at - k] for k in range(1, q + 1)]]
    x = np.column_stack(columns)
    b = np.linalg.lstsq(x, w[at], rcond=None)[0]
    rss = ((w[at] - x @ b) ** 2).sum()
    w, e, level, out = list(w), list(e), train[-1], []
    for _ in range(horizon):
        value = float(np.dot(b, [1, *[w[-k] for k in range(1, p + 1)], *([w[-7]] if s else []), *[e[-k] for k in range(1, q + 1)]]))
        w.append(value)
        e.append(0.0)
        level = level + value if d else value
        out.append(level)
    return len(at) * np.log(rss / len(at)) + 2 * (x.shape[1] + 1), len(at), np.array(out)


def test_orders_equal_single_fits(spark):
    y = weekly(200, seed=8) + np.cumsum(np.random.default_rng(5).normal(0, 1, 200))
    hints = spark.createDataFrame([("s", 0)], "product_id string, d int")
    trials = fc.arima_trials(frame(spark, s=y, plain=y), hints).collect()
    assert {r.n for r in trials} == {200 - 30 - fc.LONG - 3}
    assert len(trials) == 2 * len(fc.CANDIDATES) + 1 and {r.product_id for r in trials if r.kind == "arima"} == {"s"}
    for r in trials:
        aic, n, ahead = order_brute(y, r.p, r.d, r.q, r.s, 30)
        assert (r.aic, r.n) == pytest.approx((aic, n), rel=1e-4) and r.mape == pytest.approx(np.mean(np.abs(y[-30:] - ahead) / y[-30:]), rel=1e-3)


def test_arima_benchmark(spark):
    got = {r.product_id: r for r in fc.arima_benchmark(frame(spark, s=weekly(200), short=weekly(89), line=np.arange(120.0) + 5), None).collect()}
    assert set(got) == {"s", "line"} and all(r.arima_mape is None for r in got.values())
    assert got["line"].auto_arima_mape < 0.01
    errors = {k: got["s"][f"{k}_mape"] for k in ("seasonal", "auto_arima")}
    assert got["s"].winner == min(errors, key=errors.get) and min(errors.values()) < 0.1


def test_quantile_curves(spark):
    r = np.random.default_rng(6)
    y = 50 + 10 * np.sin(2 * np.pi * np.arange(400) / 7) + r.exponential(8, 400)
    points = curves.series_points(frame(spark, s=y), fc.QUANTILE_DESIGN, 60).cache()
    fits = fc.quantile_fits(points, fc.QUANTILE_DESIGN)
    found = {row.quantile: (row.loss, row.below) for row in fc.pinball(points, fits).collect()}
    for q, (loss, below) in found.items():
        assert abs(below - q) < 0.05
        # The least-squares curve moved by its residual quantile does not do better.
        t = np.arange(400) + EPOCH
        x = rows_of(fc.QUANTILE_DESIGN, t, t[0], t[-1])
        beta, *_ = refit(x, y, ridge_of(fc.QUANTILE_DESIGN))
        rest = y - x @ beta - np.quantile(y - x @ beta, q)
        assert loss <= np.mean(np.where(rest >= 0, q * rest, (q - 1) * rest))


def test_quantiles_are_ordered_and_widen(spark):
    df = frame(spark, s=weekly(200), low=np.abs(np.random.default_rng(2).normal(size=100)))
    got = fc.quantile_forecast(df).collect()
    assert len(got) == 180 and all(0 <= r["p10"] <= r["p50"] <= r["p90"] for r in got)
    width = {r["step"]: r["p90"] - r["p10"] for r in got if r["product_id"] == "s"}
    assert width[90] > width[1]
    bands = fc.residual_quantile_forecast(df).collect()
    assert len(bands) == 60 and all(0 <= r["p10"] <= r["p50"] <= r["p90"] for r in bands)


def test_all_scales_of_the_grid_are_tried():
    assert len(list(itertools.product(*fc.SEARCH_SPACE.values()))) == 640
