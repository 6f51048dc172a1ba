import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.operators import drift
from shelfline.operators import metrics as mt

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def sides(spark, reference, production):
    data = [("reference", float(v)) for v in reference] + [("production", float(v)) for v in production]
    return spark.createDataFrame(data, "side string, v double")


def numpy_psi(ref, prod):
    bins = np.linspace(min(ref.min(), prod.min()), max(ref.max(), prod.max()), 11)
    bins[-1] += 1e-8
    p, q = [(np.histogram(x, bins)[0] / len(x)).clip(1e-8) for x in (ref, prod)]
    return max(0.0, float(np.sum((q - p) * np.log(q / p))))


def test_psi_matches_numpy_and_is_zero_for_equal_samples(spark):
    rng = np.random.default_rng(42)
    ref, prod = rng.uniform(1, 90, 400), rng.uniform(60, 200, 300)
    assert drift.psi(sides(spark, ref, prod), ["v"]).first()["psi"] == pytest.approx(numpy_psi(ref, prod))
    assert drift.psi(sides(spark, ref, ref), ["v"]).first()["psi"] == 0.0


def test_constant_and_empty_sides(spark):
    assert drift.psi(sides(spark, [1, 1], [1]), ["v"]).first()["psi"] == 0.0
    empty = drift.drift_report(sides(spark, [1, 2], []), ["v"]).first()
    assert (empty["psi"], empty["ks"], empty["p_value"], empty["drift_detected"]) == (0.0, 0.0, 1.0, False)


def test_nan_and_null_are_dropped(spark):
    df = sides(spark, [1, 2, 3], [1, 2, 3]).unionByName(
        spark.createDataFrame([("reference", float("nan")), ("production", None)], "side string, v double"))
    got = drift.drift_report(df, ["v"]).first()
    assert (got["psi"], got["ks"], got["drift_detected"]) == (0.0, 0.0, False)


@SLOW
@given(st.lists(st.integers(0, 8), min_size=1, max_size=40), st.lists(st.integers(2, 11), min_size=1, max_size=40))
def test_ks_statistic_matches_brute_force(spark, a, b):
    want = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in set(a + b))
    assert drift.ks(sides(spark, a, b), ["v"]).first()["ks"] == pytest.approx(want)


def test_ks_p_value_is_the_kolmogorov_tail(spark):
    # The tail function at 1.36 is about 0.0495, the usual 5% point.
    n, root = 10_000, math.sqrt(5000)
    d = 1.36 / (root + 0.12 + 0.11 / root)
    row = spark.createDataFrame([(d, n)], "d double, n int")
    assert row.select(drift.kolmogorov_p(F.col("d"), F.col("n"), F.col("n"))).first()[0] == pytest.approx(0.0495, abs=3e-4)
    assert row.select(drift.kolmogorov_p(F.lit(0.0), F.col("n"), F.col("n"))).first()[0] == 1.0


def test_js_divergence_bounds(spark):
    apart = sides(spark, [0] * 50, [10] * 50)
    assert drift.js_divergence(apart, ["v"], form="divergence").first()["js"] == pytest.approx(math.log(2), abs=1e-5)
    assert drift.js_divergence(apart, ["v"]).first()["js"] == pytest.approx(math.sqrt(math.log(2)), abs=1e-5)
    assert drift.js_divergence(sides(spark, [1, 2], [1, 2]), ["v"]).first()["js"] == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError):
        drift.js_divergence(apart, ["v"], form="x")


def decision(spark, psis, current, base):
    df = spark.createDataFrame([(psis, current, base)], "summary map<string,double>, mape_current double, mape_baseline double")
    return drift.retrain_decision(df).first()["retrain"]


def test_retrain_decision(spark):
    assert decision(spark, {"a": 0.21}, 8.0, 8.0)
    assert not decision(spark, {"a": 0.20, "_overall_drift_score": 0.9}, 9.2, 8.0)
    assert decision(spark, {"a": 0.0}, 9.3, 8.0)
    assert not decision(spark, {}, 8.0, 8.0)


def test_psi_summary(spark):
    df = spark.createDataFrame([("recency_days", 0.23), ("frequency", 0.05), ("monetary", 0.11)], "column string, psi double")
    got = drift.psi_summary(df).first()
    assert got["summary"] == {"recency_days": 0.23, "frequency": 0.05, "monetary": 0.11, "_overall_drift_score": 0.13}
    assert (got["n_drifted"], got["max_feature"]) == (1, "recency_days")


def test_metric_rows_drop_internal_and_unknown_names(spark):
    names = ["psi_a", "psi__overall", "demand_mape_A", "churn_auc", "stockout_rate", "dq_score_pos", "other", "api_p95_latency_seconds"]
    df = spark.createDataFrame([(n, 1.0) for n in names], "name string, value double")
    got = {(r["family"], r["label"]) for r in drift.metric_rows(df).collect()}
    assert got == {("psi", "a"), ("demand_mape", "A"), ("churn_auc", None), ("stockout_rate", None), ("dq_score", "pos"), ("api_p95_latency_seconds", None)}


def test_shared_columns(spark):
    a = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, s string")
    assert drift.shared_columns(a, a.drop("a")) == ["b"]
    assert drift.both_sides(a, a.drop("a")).columns == ["side", "b"]


def scores(spark, pairs):
    data = [(f"c{i:04d}", float(p), int(y)) for i, (p, y) in enumerate(pairs)]
    return spark.createDataFrame(data, "id string, prediction double, target int")


@SLOW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1)), min_size=2, max_size=30))
def test_auc_matches_pair_counting(spark, pairs):
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    got = mt.auc(scores(spark, pairs)).first()["auc"]
    if not pos or not neg:
        assert got is None
    else:
        assert got == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))


def test_classification_metrics(spark):
    got = mt.classification_metrics(scores(spark, [(0.9, 1), (0.6, 0), (0.4, 1), (0.1, 0)])).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"], got["precision"], got["recall"], got["f1"], got["auc"]) == (1, 1, 1, 1, 0.5, 0.5, 0.5, 0.75)
    assert got["drifted"]
    one_class = mt.classification_metrics(scores(spark, [(0.1, 0), (0.2, 0)])).first()
    assert one_class["auc"] is None and not one_class["drifted"] and one_class["f1"] == 0.0


def test_precision_at_top_breaks_ties_by_key(spark):
    got = mt.precision_at_top(scores(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0), (0.5, 0)]), "id").first()
    assert (got["n_top"], got["precision_at_top20"]) == (1, 1.0)
    assert mt.precision_at_top(scores(spark, [(0.5, 1), (0.9, 0)]), "id").first()["n_top"] == 1


def test_roc_points(spark):
    got = [(r["fpr"], r["tpr"]) for r in mt.roc_points(scores(spark, [(0.9, 1), (0.6, 0), (0.4, 1), (0.1, 0)])).orderBy(F.desc("threshold")).collect()]
    assert got == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(10.0, 11.0, 9.0, 12.0), (20.0, 18.0, 19.0, 21.0), (0.0, 1.0, 5.0, 6.0)], "y double, yhat double, lo double, hi double")
    got = mt.regression_metrics(df, lower="lo", upper="hi").first()
    assert got["rmse"] == pytest.approx(math.sqrt(2)) and got["mae"] == pytest.approx(4 / 3)
    assert got["mape_pct"] == pytest.approx((0.1 + 0.1 + 1) / 3 * 100) and got["r2"] == pytest.approx(1 - 6 / 200)
    assert got["coverage"] == pytest.approx(2 / 3) and got["drifted"]
    assert mt.regression_metrics(df).first()["coverage"] == 0.9


def test_pinball_and_horizon(spark):
    df = spark.createDataFrame([(10.0, 8.0, 9.0, 12.0, 1)], "y double, p10 double, p50 double, p90 double, h int")
    assert mt.pinball_loss(df).first()[0] == pytest.approx((0.2 + 0.5 + 0.2) / 3)
    assert mt.horizon_mape(df).first()["mape"] == pytest.approx(0.1)


def test_gates_and_promotion(spark):
    df = spark.createDataFrame([("m", "mape", 0.15), ("m", "auc", 0.91), ("m", "unknown", 1.0)], "model string, metric string, value double")
    got = {r["metric"]: (r["soft_status"], r["hard_status"]) for r in mt.kpi_gate(df).collect()}
    assert got == {"mape": ("FAIL", "PASS"), "auc": ("PASS", "PASS")}
    pairs = spark.createDataFrame([("d", "minimise", 10.0, 9.5, 10.0), ("c", "maximise", 0.90, 0.94, 0.90), ("x", "minimise", 10.0, 5.0, 4.0)],
                                  "model string, direction string, champion double, challenger double, gate double")
    got = {r["model"]: (r["improvement_pct"], r["promote"]) for r in mt.champion_challenger(pairs).collect()}
    assert got == {"d": (5.0, True), "c": (4.44, False), "x": (50.0, False)}
