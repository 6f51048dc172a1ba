"""Ordered operators against brute force, with one hot key and with ties."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.operators.refine import exact_quantiles
from shelfline.operators.ordered import (
    as_of_join, day_spine, global_rank, newest_per_key, one_row, running_totals,
)
from shelfline.operators.profiling import quantile_buckets


def hot_frame(spark, n=3000, seed=1):
    rng = random.Random(seed)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(50), i, rng.randrange(-5, 9)) for i in range(n)]
    return spark.createDataFrame(data, "k string, v int, id int, x int")


def test_running_totals_equal_plain_window(spark, rows):
    df = hot_frame(spark)
    order = [F.col("v").desc(), F.col("id")]
    plain = df.withColumn("s", F.sum("x").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(running_totals(df, order, {"s": F.col("x")})) == rows(plain)


def test_running_totals_within_keys_with_totals(spark, rows):
    df = hot_frame(spark)
    order = [F.col("v"), F.col("id")]
    w = Window.partitionBy("k")
    plain = df.withColumns({
        "s": F.sum("x").over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)), "s_total": F.sum("x").over(w)})
    assert rows(running_totals(df, order, {"s": F.col("x")}, keys=["k"], with_totals=True)) == rows(plain)


def test_global_rank(spark):
    ranks = [r["r"] for r in global_rank(hot_frame(spark), [F.col("v"), F.col("id")], "r").orderBy("v", "id").collect()]
    assert ranks == list(range(1, len(ranks) + 1))


def test_running_totals_of_empty_frame(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert running_totals(df, [F.col("v")], {"s": F.col("v")}, keys=["k"]).count() == 0


def brute_as_of(entities, features, ttl_days):
    out = []
    for key, at, eid in entities:
        seen = [(t, v) for k, t, v in features if k == key and t <= at]
        best = max(seen) if seen else None
        if best and ttl_days is not None and best[0] < at - dt.timedelta(days=ttl_days):
            best = None
        out.append((key, at, eid, best[1] if best else None))
    return sorted(out, key=repr)


def test_as_of_join_matches_brute_force(spark, rows):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)

    def key():
        return "hot" if rng.random() < 0.34 else f"k{rng.randrange(15)}"

    entities = [(key(), base + dt.timedelta(minutes=rng.randrange(40000)), i) for i in range(500)]
    entities += entities[:5]  # repeated rows are all kept
    times = rng.sample(range(40000), 600)
    features = [(key(), base + dt.timedelta(minutes=m), i) for i, m in enumerate(times)]
    e = spark.createDataFrame(entities, "k string, at timestamp_ntz, eid int")
    f = spark.createDataFrame(features, "k string, ft timestamp_ntz, val int")
    for ttl in (None, 1, 7):
        got = rows(as_of_join(e, f, ["k"], "at", "ft", ["val"], ttl).drop("feature_ts"))
        assert got == brute_as_of(entities, features, ttl)


def test_as_of_join_never_looks_ahead_and_ttl_is_inclusive(spark):
    day = dt.datetime(2024, 1, 10)
    e = spark.createDataFrame([("a", day)], "k string, at timestamp_ntz")

    def found(at):
        f = spark.createDataFrame([("a", at, 1)], "k string, ft timestamp_ntz, val int")
        return as_of_join(e, f, ["k"], "at", "ft", ["val"], 7).first()["val"]

    assert found(day + dt.timedelta(seconds=1)) is None
    assert found(day) == 1
    assert found(day - dt.timedelta(days=7)) == 1
    assert found(day - dt.timedelta(days=7, seconds=1)) is None


def test_as_of_join_keeps_a_null_feature_value(spark):
    day = dt.datetime(2024, 1, 10)
    e = spark.createDataFrame([("a", day)], "k string, at timestamp_ntz")
    f = spark.createDataFrame([("a", day - dt.timedelta(days=2), 5), ("a", day - dt.timedelta(days=1), None)], "k string, ft timestamp_ntz, val int")
    row = as_of_join(e, f, ["k"], "at", "ft", ["val"]).first()
    assert row["val"] is None and row["feature_ts"] == day - dt.timedelta(days=1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e3, 1e3)), min_size=1, max_size=40))
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([("c", float(v)) for v in values], "column string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, probs).first()
    np.testing.assert_allclose([got[f"q{i}"] for i in range(len(probs))], np.quantile(values, probs), rtol=1e-9, atol=1e-9)


def test_quantile_buckets_match_qcut(spark):
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=200), rng.integers(0, 6, 200).astype(float), np.array([1.0] * 150 + list(range(50)))):
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
        got = [r["b"] for r in quantile_buckets(df, "v", 10, "b").orderBy("id").collect()]
        assert got == list(pd.qcut(values, 10, labels=False, duplicates="drop"))


def test_day_spine_fills_gaps_with_zero(spark, rows):
    d = dt.date
    df = spark.createDataFrame([("a", d(2024, 1, 1), 2.0), ("a", d(2024, 1, 4), 3.0), ("b", d(2024, 1, 2), 1.0)], "k string, date date, q double")
    assert rows(day_spine(df, "k", "date", "q"), "k", "date", "q") == [
        ("a", d(2024, 1, 1), 2.0), ("a", d(2024, 1, 2), 0.0), ("a", d(2024, 1, 3), 0.0), ("a", d(2024, 1, 4), 3.0), ("b", d(2024, 1, 2), 1.0)]


def test_newest_per_key_and_one_row(spark, rows):
    df = hot_frame(spark, 300)
    newest = newest_per_key(df, ["k"], [F.col("id").desc()])
    assert rows(newest, "k", "id") == rows(df.groupBy("k").agg(F.max("id").alias("id")))
    assert df.withColumn("b", one_row(df, hi=F.max("id"))).select("b.hi").first()[0] == 299
