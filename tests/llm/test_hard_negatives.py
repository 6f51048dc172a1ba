"""Mining against a plain comparison of all pairs, with a small tree so that there are many leaves, parts and blocks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import hard_negatives as hn


def brute(rows, every=5, k=5, low=80):
    own = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) <= 1 << 62:
            own.append((vec_id, whole, label))
    out = []
    for a, (anchor, x, label) in enumerate(own):
        if anchor % every:
            continue
        met = sorted((-sum(p * q for p, q in zip(x, y)), other, b) for b, (other, y, _) in enumerate(own) if b != a and len(y) == len(x))
        for score, positive, b in [m for m in met if own[m[2]][2] == label][:k]:
            fits = [m for m in met if own[m[2]][2] != label and -low * score <= -100 * m[0] <= -100 * score][:k]
            out += [(anchor, positive, n + 1, m[1], -score, -m[0]) for n, m in enumerate(fits)]
    return out


def vectors():
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 8))
    rows = [(k, [float(x) for x in centres[k % 12] + 0.05 * r.normal(size=8)], int(r.integers(0, 3))) for k in range(400)]
    rows += [(400 + k, [float(x) for x in r.normal(size=8) * 3], k % 2) for k in range(60)]
    rows += [(500 + k, [0.25] * 8, k % 2) for k in range(45)]  # copies, and ties
    rows += [(600, None, 1), (605, [], 1), (610, [None] * 8, 1), (615, [math.nan] * 8, 1), (620, [math.inf] * 8, 1), (625, [0.0] * 8, 0), (630, rows[0][1], None), (None, rows[0][1], 1)]
    rows += [(635, [], 0), (640, [1e300] * 8, 1), (645, [float(1 << 20)] * 8, 1), (646, [float(1 << 20)] * 8, 1), (647, [float((1 << 20) - 2)] * 8, 0), (5, rows[5][1], rows[5][2]), (5, rows[5][1], rows[5][2])]
    rows += [(650 + k, [1.0 * k, 2.0], k % 3) for k in range(20)]
    return rows


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(*r, 1) for r in vectors()], "vec_id long, embedding array<double>, label int, row int")


def test_against_all_pairs(frame, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 20)
    monkeypatch.setattr(hn, "STRIP", 7)
    got = hn.mine(frame, every=5, fanout=3, depth=3, part=16, sample=200)
    want = brute(vectors())
    assert len(want) > 200
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_subtrees_are_eliminated(spark):
    r = np.random.default_rng(2)
    centres = r.normal(size=(16, 8)) * 4
    rows = [(k, [float(x) for x in centres[k % 16] + 0.1 * r.normal(size=8)], k % 3) for k in range(2000)]
    index = hn.Index(hn.whole_rows(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")), part=64, fanout=4, depth=3)
    tree = index.tree.value
    anchors = np.floor(256 * np.array([v for _, v, _ in rows[:50]]))
    own = (anchors * anchors).sum(1)
    windows = np.stack([0.9 * own, 1.1 * own])
    opened = tree.open_leaves(anchors, windows[0][:, None], windows[1][:, None])
    assert sum(len(at) for _, at in opened) < 0.5 * len(anchors) * tree.leaves
    # What is eliminated holds no row of the window.
    every = np.floor(256 * np.array([v for _, v, _ in rows]))
    leaf, score = tree.leaf_of(every), hn.scores(anchors, every)
    alive = {(int(a), int(own_leaf)) for own_leaf, at in opened for a in at}
    for a, b in zip(*np.nonzero((score >= windows[0][:, None]) & (score <= windows[1][:, None]))):
        assert (int(a), int(leaf[b])) in alive


def test_few_rows(spark, frame):
    assert hn.mine(frame.limit(0)).count() == 0
    assert hn.mine(frame.where("vec_id = 600")).count() == 0
    one = hn.mine(frame.where(F.col("vec_id") == 100))
    assert one.count() == 0 and one.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_scores_are_exact():
    r = np.random.default_rng(1)
    for top in (1 << 10, 1 << 24, 1 << 29):
        a, b = (r.integers(-top, top, size=(4, 9)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert hn.scores(a.astype(float), b.astype(float)).tolist() == want
