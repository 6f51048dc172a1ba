import hashlib

import pytest
from pyspark.sql import functions as F

from shelfline.functions import scalars as sc
from shelfline.operators import customers as cu
from shelfline.operators import frames as fr


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_risk_tier_boundaries(spark):
    p = [0.0, 0.4, 0.6, 0.8, 0.81, 1.0]
    assert column(spark, p, sc.risk_tier) == ["Low", "Medium", "High", "Critical", "Critical", "Critical"]
    assert column(spark, p, lambda c: sc.risk_tier(c, "exclusive")) == ["Low", "Low", "Medium", "High", "Critical", "Critical"]
    assert column(spark, p, lambda c: sc.risk_tier(c, "interval")) == [None, "Low", "Medium", "High", "Critical", "Critical"]
    with pytest.raises(ValueError):
        column(spark, p, lambda c: sc.risk_tier(c, "other"))


def test_urgency_and_bands(spark):
    days = [7.0, 7.1, 14.0, 30.0, 30.1]
    assert column(spark, days, sc.stock_urgency) == ["Critical", "High", "High", "Medium", "OK"]
    assert column(spark, days, lambda c: sc.stock_urgency(c, False)) == ["Critical", "High", "High", "Medium", "Medium"]
    assert column(spark, [10.0, 15.0, 15.1], sc.mape_band) == ["green", "amber", "red"]
    assert column(spark, [0.1, 0.2, 0.21], sc.psi_band) == ["stable", "moderate", "severe"]


def test_churn_label(spark):
    df = spark.createDataFrame([(31, 1), (30, 1), (31, 2)], "r int, f int")
    assert [r[0] for r in df.select(sc.churn_label(F.col("r"), F.col("f"))).collect()] == [1, 0, 0]


def test_winner_skips_nan_and_first_wins_ties(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 2.0, 1.0), (1.0, 1.0, 1.0), (nan, nan, nan), (None, 3.0, nan)], "arima double, prophet double, auto_arima double")
    pick = sc.winner_by_min({c: F.col(c) for c in df.columns}, "arima")
    assert [r[0] for r in df.select(pick).collect()] == ["auto_arima", "arima", "arima", "prophet"]


def test_percent_error_of_zero_actual(spark):
    df = spark.createDataFrame([(0.0, 2.0), (4.0, 5.0), (-4.0, -5.0)], "a double, p double")
    assert [r[0] for r in df.select(sc.percent_error(F.col("a"), F.col("p"))).collect()] == [2.0, 0.25, 0.25]


def test_cache_key(spark):
    df = spark.sql("SELECT 's' AS s, 't' AS t, 30 AS h, DATE '2024-01-05' AS d")
    expected = "demand:" + hashlib.md5(b"s:t:30:2024-01-05").hexdigest()[:12]
    assert df.select(sc.demand_cache_key(F.col("s"), F.col("t"), F.col("h"), F.col("d"))).first()[0] == expected


def test_rule_score_defaults_and_clip(spark):
    df = spark.createDataFrame([(None, None, None), (180, 0, 0.0), (0, 50, 5000.0)], "r int, f int, m double")
    got = [r[0] for r in df.select(sc.rule_churn_score(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert got == pytest.approx([0.35 * 30 / 180 + 0.30 * 0.8 + 0.20 * 0.98, 0.85, 0.02])


def actions(spark, contributions, recency=None, n=3):
    df = spark.createDataFrame([(contributions, recency)], "contributions map<string,double>, recency_days int")
    return [(a["channel"], a["urgency"]) for a in cu.retention_actions(df, max_actions=n).first()["actions"]]


def test_retention_rules(spark):
    assert actions(spark, {}) == [("Push Notification", "Medium")]  # a missing frequency fires its rule
    assert actions(spark, {"frequency": -0.02}) == [("SMS", "High")]
    every = {"recency_days": 0.06, "frequency": 0.0, "monetary": 0.04, "rolling_mean_7d": 0.06}
    assert actions(spark, every, 61) == [("Email", "High"), ("Push Notification", "Medium"), ("In-App", "Low")]
    assert actions(spark, every, 60, 4)[0] == ("Email", "Medium") and len(actions(spark, every, 60, 4)) == 4
    assert actions(spark, {"recency_days": 0.06, "frequency": -1.0}) == [("Email", "Medium")]


def test_retention_text_names_the_days(spark):
    df = spark.createDataFrame([({"recency_days": 1.0}, 12), ({"recency_days": 1.0}, None)], "contributions map<string,double>, recency_days int")
    texts = [r["actions"][0]["action"] for r in cu.retention_actions(df).collect()]
    assert "was 12 days ago" in texts[0] and "was 45 days ago" in texts[1]


def test_persona_actions(spark):
    df = spark.createDataFrame([("a", "At-Risk VIP", 0.1), ("b", "Champion", 0.4), ("c", "Champion", 0.41), ("d", "Lost", 0.0)], "customer_id string, persona string, churn_proba double")
    got = sorted((r["customer_id"], r["channel"]) for r in cu.persona_actions(df).collect())
    assert got == [("a", "Email"), ("a", "Phone"), ("c", "Push"), ("d", "SMS")]


def test_batches(spark):
    ids = spark.createDataFrame([(" a ",), ("  ",), ("b",)], "id string")
    assert sorted(r[0] for r in fr.check_batch(ids, "id").collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        fr.check_batch(ids.filter("id = '  '"), "id")
    assert fr.check_batch(spark.range(6000).select(F.col("id").cast("string")), "id").count() == 6000
    assert fr.check_horizon(90) == 90
    with pytest.raises(ValueError):
        fr.check_horizon(91)


def test_best_trial_and_defaults(spark):
    df = spark.createDataFrame([("a", "1", 0.3, "SUCCESS", 5), ("a", "2", 0.2, "FAILED", 6), ("a", "3", 0.25, "SUCCESS", 7), ("b", "4", None, "FAILED", 8)], "k string, trial_id string, cv_mape double, status string, p int")
    got = {r["k"]: (r["cv_mape"], r["p"]) for r in fr.best_trial(df, ["k"], ["p"], {"p": F.lit(1)}).collect()}
    assert got == {"a": (0.25, 7), "b": (None, 1)}
    assert [r["trial_id"] for r in fr.top_trials(df).collect()] == ["3", "1"]


def test_quantile_checks(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 3.0, 2.0), (-1.0, 2.0, 3.0), (2.0, 2.0, 2.0)], "p10 double, p50 double, p90 double")
    assert fr.valid_quantiles(df).count() == 2
    assert tuple(fr.point_only(df, False).first()) == (2.0, 2.0, 2.0)


def test_scoreboard_and_experiments(spark):
    res = spark.createDataFrame([("a", 0.05, False), ("b", 0.5, True), ("c", 0.15, False)], "model string, mape double, failed boolean")
    got = {r["model"]: (round(r["value"], 6), r["status"]) for r in fr.scoreboard(res, 0.10).collect()}
    assert got == {"a": (0.05, "PASS"), "b": (1.0, "FAIL"), "c": (0.15, "FAIL"), "average": (0.1, "PASS")}
    exp = spark.createDataFrame([("x", "m", 0.1, "minimise"), ("y", "m", 0.5, "maximise")], "experiment string, metric string, target double, direction string")
    runs = spark.createDataFrame([("x", f"r{i:02d}", i / 100) for i in range(30)] + [("x", "none", None)], "experiment string, run_name string, value double")
    out = fr.experiment_summary(exp, runs).collect()
    assert len(out) == 21 and {r["status"] for r in out if r["experiment"] == "y"} == {"NOT RUN"}
    assert max(r["value"] for r in out if r["experiment"] == "x") == 0.19


def test_whatif(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 30.0)], "k string, p50 double")
    got = fr.whatif_demand(df, [{"promo_pct": 10, "price_pct": 10, "temp_delta": 2}], ["k"]).first()
    assert got["total_demand"] == pytest.approx(40 * (1 + 0.1 - 0.15 + 0.01))


def test_unknown_clusters_get_the_default_profile(spark):
    df = spark.createDataFrame([(0,), (42,)], "cluster_id int")
    got = {r["cluster_id"]: (r["persona"], r["clv_tier"]) for r in cu.with_profile(df, cu.cluster_profiles(spark)).collect()}
    assert got == {0: ("Champion", "Platinum"), 42: ("Unknown", "Bronze")}
