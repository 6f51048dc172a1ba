"""Order statistics by refinement against numpy, also when every cell has to be opened many times."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.operators import drift, profiling, refine
from shelfline.sources import readers


def values():
    r = np.random.default_rng(4)
    return {
        "normal": r.normal(size=800), "money": np.round(r.lognormal(8, 2, 700), 2), "few": r.integers(0, 4, 500).astype(float), "one": np.full(50, 7.25),
        "narrow": 1e6 + r.random(900) / 1000, "wide": np.r_[-1e308, 1e308, 1e308, r.normal(size=60)], "zeros": np.r_[np.zeros(30), -0.0, 1e-320, -5e-324, 3.0],
        "single": np.array([3.5]),
    }


def long_frame(spark, columns):
    rows = [(c, float(v)) for c, own in columns.items() for v in own] + [("normal", None), ("gone", None)]
    return spark.createDataFrame(rows, "column string, value double")


@pytest.mark.parametrize("sorted_up_to", [100_000, 3])
def test_quantiles(spark, monkeypatch, sorted_up_to):
    monkeypatch.setattr(refine, "SORTED", sorted_up_to)
    columns, probs = values(), [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = {r["column"]: r for r in refine.exact_quantiles(long_frame(spark, columns), probs).collect()}
    assert set(got) == set(columns)
    for c, own in columns.items():
        assert got[c]["n_values"] == len(own)
        ordered = np.sort(own)
        for i, p in enumerate(probs):
            at = (len(own) - 1) * p
            lo, hi = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            assert got[c][f"q{i}"] == pytest.approx(lo + (hi - lo) * (at - np.floor(at)), rel=1e-12, abs=0) or lo != hi


@pytest.mark.parametrize("sorted_up_to", [100_000, 3])
def test_largest_gap(spark, monkeypatch, sorted_up_to):
    monkeypatch.setattr(refine, "SORTED", sorted_up_to)
    r = np.random.default_rng(9)
    pairs = {c: (own, r.permutation(own)[: max(1, len(own) // 2)] + (0.001 if c in ("normal", "narrow") else 0)) for c, own in values().items()}
    pairs["same"] = (np.arange(50.0), np.arange(50.0))
    rows = [(c, float(v), int(side == 0), int(side == 1)) for c, own in pairs.items() for side in (0, 1) for v in own[side]] + [("lone", 1.0, 1, 0)]
    got = {x["column"]: x for x in refine.largest_gap(spark.createDataFrame(rows, "column string, value double, n_ref int, n_prod int")).collect()}
    for c, (a, b) in pairs.items():
        points = np.concatenate([a, b])
        want = np.abs((a[None, :] <= points[:, None]).mean(1) - (b[None, :] <= points[:, None]).mean(1)).max()
        assert got[c]["gap"] == pytest.approx(want, abs=1e-12), c
    assert got["lone"]["gap"] is None


def test_cells_never_fall_as_values_grow(spark):
    r = np.random.default_rng(1)
    points = np.unique(np.r_[r.normal(size=2000) * 10.0 ** r.integers(-300, 300, 2000), 0.0, 5e-324, -5e-324, np.inf, -np.inf, 1.0, np.nextafter(1.0, 2)])
    cells = [x[0] for x in spark.createDataFrame([(float(v),) for v in points], "v double").orderBy("v").select(refine.grid_cell(F.col("v"))).collect()]
    assert cells == sorted(cells)


def test_no_copy_is_written_but_cells(spark, monkeypatch):
    written, original = [], refine.stage_table
    monkeypatch.setattr(refine, "stage_table", lambda df, label: (written.append(df.count()), original(df, label))[1])
    r = np.random.default_rng(2)
    df = spark.createDataFrame([(("reference", "production")[k % 2], float(v)) for k, v in enumerate(r.normal(size=20_000))], "side string, v double")
    drift.ks(df, ["v"]).collect()
    profiling.iqr_outliers(df.select("v"), ["v"]).collect()
    assert max(written) < 8000


def test_describe_keeps_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0, None), (None, 2.0, None)], "gone string, v double, hole double")
    got = {r["column"]: r for r in profiling.describe_all(df).collect()}
    assert got["gone"]["count"] == 0 and got["gone"]["unique"] == 0 and got["gone"]["top"] is None and got["hole"]["count"] == 0 and got["v"]["q50"] == 1.5


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_smallest_rows_match_brute_force(spark, share):
    rng = np.random.default_rng(3)
    # Half of the rows hold one value; others are null, NaN, infinite or far apart.
    values = [1.5] * 200 + [None] * 30 + [float("nan")] * 10 + [float("-inf")] * 5 + [float(v) for v in rng.normal(scale=10.0 ** rng.integers(-8, 8, 155))]
    data = [(i, v, (None, "a", "b")[i % 3], i) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "id int, v double, k string, _cut int").repartition(5)
    got = refine.smallest_rows(df, F.col("v"), [F.col("id")], lambda n: F.floor(n * F.lit(share)), "_in", ["k"])
    assert got.columns == ["id", "v", "k", "_cut", "_in"] and got.count() == len(data)
    place = lambda r: (math.inf if r[1] is None or math.isnan(r[1]) else r[1], r[0])
    wanted = set()
    for k in (None, "a", "b"):
        own = sorted((r for r in data if r[2] == k), key=place)
        wanted |= {r[0] for r in own[: math.floor(len(own) * share)]}
    assert {r["id"] for r in got.filter("_in").collect()} == wanted


def test_smallest_rows_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert refine.smallest_rows(df, F.col("v"), [F.col("id")], lambda n: n, "_in").count() == 0


def test_sample_with_repeated_keys_is_the_same_for_every_order(spark):
    """The share ends among rows of one key: whatever order they are read in, the same rows are drawn."""
    rows = [(f"k{i // 40}", i, None if i % 3 else float(i)) for i in range(400)]
    schema = "key string, n int, x double"
    drawn = []
    for seed in range(4):
        mixed = random.Random(seed).sample(rows, len(rows))
        frame = spark.createDataFrame(mixed, schema).repartition(seed + 1)
        drawn.append(sorted((tuple(r) for r in readers.sample_fraction(frame, ["key"], 0.125).collect()), key=repr))
    assert len(drawn[0]) == 50 and all(d == drawn[0] for d in drawn)
