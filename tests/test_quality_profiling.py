import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import profiling as pf
from shelfline.operators import quality as dq

POS = "transaction_id string, customer_id string, product_id string, timestamp timestamp_ntz, unit_price double, quantity int, return_flag boolean"


def pos(spark, changes=(), n=100):
    base = [[f"t{i}", "c", "p", dt.datetime(2024, 1, 1), 5.0, 1, i % 2 == 0] for i in range(n)]
    for row, column, value in changes:
        base[row][column] = value
    return spark.createDataFrame([tuple(r) for r in base], POS)


def verdicts(spark, changes=(), n=100):
    return {r["rule"]: (r["n_failing"], r["passed"]) for r in dq.evaluate_rules(pos(spark, changes, n), dq.POS_RULES).collect()}


def test_clean_table_passes_every_rule(spark):
    got = verdicts(spark)
    assert len(got) == 8 and all(passed for _, passed in got.values())
    score = dq.suite_score(dq.evaluate_rules(pos(spark), dq.POS_RULES), "pos")
    assert dq.enforce(score) == 1.0


def test_one_null_key_fails_but_a_missing_price_is_not_out_of_range(spark):
    got = verdicts(spark, [(0, 0, None), (1, 4, None)])
    assert got["not_null:transaction_id"] == (1, False)
    assert got["between:unit_price"] == (0, True)


def test_range_rules_tolerate_a_small_share(spark):
    assert verdicts(spark, [(0, 4, 10000.0), (1, 4, 0.01)])["between:unit_price"] == (0, True)
    assert verdicts(spark, [(0, 4, 10000.1)], n=1000)["between:unit_price"] == (1, True)
    assert verdicts(spark, [(0, 4, 0.0)], n=999)["between:unit_price"] == (1, False)


def test_all_copies_of_a_duplicate_fail(spark):
    assert verdicts(spark, [(0, 0, "t1"), (2, 0, "t1")])["unique:transaction_id"] == (3, False)


def test_seven_of_eight_trips_the_gate(spark):
    score = dq.suite_score(dq.evaluate_rules(pos(spark, [(0, 1, None)]), dq.POS_RULES), "pos")
    assert score.first()["score"] == 0.875 and not score.first()["meets_threshold"]
    with pytest.raises(dq.QualityError):
        dq.enforce(score)


def test_overall_is_the_mean_and_empty_suites_pass(spark):
    two = spark.createDataFrame([("a", 1.0), ("b", 0.95)], "suite string, score double")
    assert dq.overall_score(two).first()["overall_score"] == 0.975
    none = spark.createDataFrame([], "rule string, passed boolean")
    assert dq.suite_score(none, "x").first()["score"] == 1.0


def test_null_key_counts(spark):
    got = dq.null_key_counts(pos(spark, [(i, 0, None) for i in range(5)] + [(0, 1, None)]), ["transaction_id", "customer_id"]).first()
    assert (got["n_rows"], got["n_bad"], got["null_transaction_id"], got["null_customer_id"]) == (100, 5, 5, 1)


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "v double")
    got = pf.iqr_outliers(df, ["v"]).first()
    assert (got["lower"], got["upper"], got["n_outliers"]) == (-1.0, 7.0, 1)


def test_missing_rate_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, "a"), (1, "a")], "a int, b string")
    got = {r["column"]: (r["missing_rate"], r["flagged"]) for r in pf.missing_rate(df).collect()}
    assert got == {"a": (0.0, False), "b": (0.4, True)}
    assert tuple(pf.duplicate_rows(df).first()) == (5, 3)


def test_correlations_with_and_without_nulls(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=300)
    data = [(float(x), float(2 * x + n), float(n) if i % 4 else None) for i, (x, n) in enumerate(zip(a, rng.normal(size=300)))]
    df = spark.createDataFrame(data, "a double, b double, c double")
    pdf = df.toPandas()
    for r in pf.correlations(df, ["a", "b", "c"]).collect():
        assert r["corr"] == pytest.approx(pdf[r["col_a"]].corr(pdf[r["col_b"]]))
    assert {r["col_a"] for r in pf.corr_matrix_top_variance(df).collect()} == {"a", "b"}


def test_profile_summary(spark):
    df = spark.createDataFrame([(1.0, 1.0, "x"), (1.0, 1.0, "x"), (2.0, 2.001, None), (4.0, 4.0, "y")], "a double, b double, s string")
    got = pf.profile_summary(df).first()
    assert (got["n_rows"], got["n_columns"], got["missing_cells_pct"], got["duplicate_rows_pct"], got["n_high_correlations"]) == (4, 3, 8.3333, 25.0, 1)


def test_describe_all_matches_pandas(spark):
    df = spark.createDataFrame([(float(i % 7), "ab"[i % 3 == 0]) for i in range(50)] + [(None, None)], "v double, s string")
    got = {r["column"]: r for r in pf.describe_all(df).collect()}
    want = df.toPandas().describe(include="all")
    for mine, theirs in (("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max"), ("count", "count")):
        assert got["v"][mine] == pytest.approx(want.loc[theirs, "v"])
    assert (got["s"]["unique"], got["s"]["top"], got["s"]["freq"]) == (2, "a", 33)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r["n"] for r in pf.histogram(df, "v").orderBy("bin").collect()]
    assert got == list(np.histogram(values, bins=60)[0])
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert sum(r["n"] for r in pf.histogram(flat, "v").collect()) == 2


def test_top_share(spark):
    df = spark.createDataFrame([(f"c{i}", float(i)) for i in range(1, 11)], "customer_id string, total_revenue double")
    got = pf.top_share(df).first()
    assert got["threshold"] == pytest.approx(8.2) and got["n_top"] == 2 and got["share_pct"] == pytest.approx(19 / 55 * 100)


def test_customer_stats(spark):
    df = spark.createDataFrame([("a", "t1", 1.0), ("a", "t2", 2.0)], "customer_id string, transaction_id string, total_amount double")
    got = pf.customer_stats(df.withColumn("total_amount", F.col("total_amount").cast("decimal(18,4)"))).first()
    assert (got["txn_count"], got["total_revenue"], got["avg_basket"]) == (2, 3.0, 1.5)
