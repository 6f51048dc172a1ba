"""Each stage of the pipeline on a fixture with nulls, empty texts, repeats and clashing columns, against brute force."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import common, decontaminate, line_dedup, personal_data, toxicity

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["_drop", "_drop_id", "_all", "n_lines", "_scan", "_id", "_hash", "_score", "_words", "_row", "found"]
WORDS = ["".join(random.Random(k).choice("abcdefgh") for _ in range(3 + k % 5)) for k in range(200)]


def text(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def rows():
    line = "This passage of well over forty characters stands in many documents."
    out = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (None, text(40, 1)), (None, text(40, 1)), (4, text(40, 1)), (5, "x" * 60_000)]
    out += [(10 + k, f"{text(30, 20 + k)}\n{line}") for k in range(7)]
    base = text(200, 5).split()
    for k in range(12):
        words = list(base)
        for j in range(k * 2):
            words[(j * 31 + k) % 200] = f"new{k}x{j}"
        out.append((30 + k, " ".join(words)))
    out += [(50, text(50, 7)), (50, text(50, 7)), (51, f"{text(20, 8)} {' '.join(ITEM)} {text(20, 9)}")]
    return [(d, t, "en", None if d == 3 else f"s{(d or 0) % 3}", None if t is None else len(t)) for d, t in out]


ITEM = text(30, 77).split()


@pytest.fixture
def docs(spark):
    frame = spark.createDataFrame(rows(), SCHEMA)
    return frame.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(d, int(d is not None and d % 5 == 0)) for d, *_ in rows()], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(ITEM)), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def plain(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_clashing_columns_stay(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == docs.columns, name
        for k, c in enumerate(CLASHING):
            assert {r[0] for r in after.select(c).distinct().collect()} <= {k}, (name, c)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() > 0
    moved, back = common.set_aside(docs, "_drop", "TEXT")
    assert moved.withColumnsRenamed(back).columns == docs.columns and "_drop" not in moved.columns and "text" not in moved.columns
    assert line_dedup.dedup(line_dedup.create(docs), docs).count() == docs.count()
    assert personal_data.find(docs, personal_data.learn(docs)).columns == docs.columns


def test_empty_tables(spark, docs, folder):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_toxicity_stage(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    costs, model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), costs, model)
    same(plain(corpus_pipeline.remove_toxic(spark, docs, folder)), [(r.doc_id, r.text) for r in scored.collect() if r._score < 0.5])


def test_line_stage(spark, docs, folder):
    gone = {k for k, n in collections.Counter(line for d, t in {r[:2] for r in rows()} for line in set((t or "").split("\n")) if len(line) >= 40 and d is not None).items() if n >= 5}
    want = []
    for d, t, *_ in rows():
        last = max((x for x, y, *_ in rows() if x is not None and any(g in (y or "") for g in gone)), default=None)
        kept = t if t is None or d == last else "\n".join(line for line in t.split("\n") if line not in gone)
        want.append((d, kept))
    after = corpus_pipeline.drop_repeated_lines(spark, docs, folder)
    same(plain(after), want)
    assert all(r.text is None or r.n_chars == len(r.text) for r in after.collect())


def test_near_copy_stage(spark, docs, folder):
    sets = brute.op3([(k, t) for k, (_, t, *_) in enumerate(rows())], 5, 80)
    groups = collections.defaultdict(list)
    for k, n, part in sets:
        groups[part if n else -1 - k].append(rows()[k][0])
    want = [min((d for d in own if d is not None), default=None) for own in groups.values()]
    same([d for d, _ in plain(corpus_pipeline.keep_one_of_near_copies(spark, docs, folder))], want)


def test_benchmark_stage(spark, docs, folder):
    found = {k for k, *_, hit in brute.op8([(k, t) for k, (_, t, *_) in enumerate(rows())], [(1, " ".join(ITEM))]) if hit}
    same(plain(corpus_pipeline.remove_contaminated(spark, docs, folder)), [r[:2] for k, r in enumerate(rows()) if k not in found])
    small = decontaminate.scan(docs.select("doc_id", "text"), spark.read.parquet(f"{folder}/benchmark.parquet"), item_bytes=20)
    assert small.where(F.size("_scan.spans") > 0).count() == len(found) == 1


def test_mixing_stage(spark, docs, folder):
    got = corpus_pipeline.mix_sources(spark, docs, folder).collect()
    size = lambda t: len((t or "").split())
    total = collections.Counter()
    for _, t, _, source, _ in rows():
        total[source] += size(t)
    # Targets by hand: shares of all words by weight, none above three times its source, the excess reshared.
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(total.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        capped = {s for s in open_ if level * weight[s] > 3 * total[s]}
        for s in capped or open_:
            target[s] = 3.0 * total[s] if capped else level * weight[s]
        left -= sum(target[s] for s in capped)
        open_ = open_ - capped if capped else set()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == total[r.source] and r.taken in (r.size, 2 * r.size, 3 * r.size)
    for s in order:
        assert sum(r.taken for r in got if r.source == s) <= 3 * total[s]
    places = sorted(r.position for r in got)
    assert places[0] == 0 and [r.position for r in got] == places
