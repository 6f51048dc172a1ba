"""Each operator on a small frame with nulls, empty texts, ties, repeated rows and clashing columns, against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shelfline.llm import components, cuckoo, curriculum, decontaminate, embedding_dups, jaccard, language_id, line_dedup, queries, token_counts, toxicity, url_reputation, warc

from . import brute

FOLDER = "/root/testdata/sf0.001"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
LONG_LINE = "  This passage of well over forty characters stands in many documents.\t"


def text(words, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(words))


def corpus():
    base = text(300, 1).split()
    docs = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE  two"), (5, "É é"), (6, "x" * 70_000), (None, text(50, 2)), (7, text(50, 2))]
    for k in range(40):  # near copies with more and more changes
        words = list(base)
        for j in range(k // 4):
            words[(j * 37 + k) % 300] = f"new{k}x{j}"
        docs.append((100 + k, " ".join(words)))
    docs += [(200 + k, f"{text(30, 50 + k)}\n{LONG_LINE}\n{text(20, 90 + k)}\n{LONG_LINE.lower()}") for k in range(8)]
    docs += [(300, text(2000, 7)), (301, text(2000, 7)), (300, text(2000, 7))]
    return docs


@pytest.fixture
def docs(spark):
    rows = [(d, t, f"s{(d or 0) % 4}" if d != 3 else None, 1, 0.5) for d, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, score double")


@pytest.fixture
def nothing(docs):
    return docs.limit(0)


def same(left, right):
    assert sorted(map(repr, left)) == sorted(map(repr, right))


def test_line_dedup(docs, nothing):
    index = line_dedup.create(docs)
    got = line_dedup.dedup(index, docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    same([tuple(r) for r in got.collect()], brute.op1(corpus()))
    assert line_dedup.dedup(line_dedup.create(nothing), nothing).count() == 0


def test_line_index_is_reversible(docs):
    table = lambda index: sorted(map(repr, index.counts.select(F.hex("key"), "n_docs", "top_doc").collect()))
    most, rest = docs.where("doc_id < 204"), docs.where("doc_id >= 204")
    grown = line_dedup.insert(line_dedup.create(most), rest)
    assert table(grown) == table(line_dedup.create(docs))
    back = line_dedup.delete(grown, rest.select("doc_id"))
    assert table(back) == table(line_dedup.create(most))
    assert line_dedup.repeated_lines(grown, docs).count() > 0
    assert line_dedup.repeated_lines(back, docs).count() == 0


def test_cuckoo_filter():
    hashes = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 20_000)
    table = cuckoo.build(hashes)
    assert cuckoo.contains(table, hashes).all()
    assert cuckoo.contains(table, hashes + 12345).mean() < 0.01
    cuckoo.delete(table, hashes[:10_000])
    assert cuckoo.contains(table, hashes[10_000:]).all() and cuckoo.contains(table, hashes[:10_000]).mean() < 0.01


def test_curriculum(docs, nothing):
    got = curriculum.mix(docs).collect()
    assert len(got) == len(corpus())
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        assert (r.position is None) == (r.taken == 0)
    assert sum(rows[0].target for rows in by.values()) == pytest.approx(sum(r.size for r in got))
    for rows in by.values():
        assert rows[0].target <= 3 * rows[0].source_size + 1e-9
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.1 * rows[0].target + 50
    assert sorted(map(repr, curriculum.mix(docs).collect())) == sorted(map(repr, got))
    assert curriculum.mix(nothing).count() == 0
    assert curriculum.schedule_weights(curriculum.SCHEDULES) == pytest.approx([1, 1, 1])


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_jaccard(docs, nothing, width, percent):
    got = jaccard.components(docs, width, percent).drop("text_hash")
    same([tuple(r) for r in got.collect()], brute.op3(corpus(), width, percent))
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert jaccard.components(nothing).count() == 0


def test_one_of_each(spark):
    a, b, c = text(60, 11), text(60, 12), text(60, 13)
    rows = [(None, a), (None, a), (9, a), (8, a), (8, a), (8, a), (None, b), (None, b), (None, b + " "), (1, c), (1, c), (None, ""), (None, ""), (2, None), (2, None), (3, b + " " + c)]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, place int")
    sets = brute.op3([(k, t) for k, (_, t) in enumerate(rows)])
    groups = collections.defaultdict(list)
    for k, n, part in sets:
        groups[part if n else -1 - k].append(k)
    smallest = [min((rows[k][0] for k in g if rows[k][0] is not None), default=None) for g in groups.values()]
    kept = jaccard.one_of_each(docs).collect()
    same([r.doc_id for r in kept], smallest)
    assert len({r.place for r in kept}) == len(kept)
    assert all(sum(r.place in g for r in kept) == 1 for g in groups.values())


def test_overlaps_in_slices():
    sets = [np.unique(np.random.default_rng(k).integers(0, 500, 200).astype(np.uint64)) for k in range(6)]
    assert (jaccard.overlaps(sets, sets[:4], 37) == [[len(set(a) & set(b)) for b in sets[:4]] for a in sets]).all()


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(tuple(r) for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 1 for k in range(1, 61)}, 100: 100, 101: 100}


def test_warc(spark):
    magic = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    html = [None, "", "short", "short", "é" * 80, "é" * 80, "a" * 99, "a" * 99, magic * 3 + "x" * 200, "x" * 120 + magic, magic * 3 + "x" * 200]
    rows = [(k, f"http://h/{k}\r\nX: y", h, 1) for k, h in enumerate(html)] + [(4, "u", "é" * 80, 1), (None, None, "é" * 80, 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    import hashlib

    first, want = {}, []
    for k, _, h, _ in rows:
        b = (h or "").encode()
        if len(b) >= 100 and k is not None:
            first[b] = min(first.get(b, k), k)
    for k, _, h, _ in rows:
        b = (h or "").encode()
        again = b in first and first[b] != k
        want.append((k, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    same([tuple(r) for r in warc.round_trip(pages).collect()], want)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_mark_in_header(spark):
    body = "x" * 120
    urls = ["http://h/0", "http://h/WARC/1.1/a", "WARC/1.", "http://h/WARC/1.0?WARC/1.", "http://h/4", "http://h/WARC/1.1\r\n\r\nContent-Length: 3", "http://h/6"]
    html = ["a", body, "WARC/1.1\r\n\r\n", body, "b", body + "WARC/1.", body]
    pages = spark.createDataFrame([(k, u, h) for k, (u, h) in enumerate(zip(urls, html))], "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == pages.count()
    assert {k: r.payload_bytes for k, r in got.items()} == {k: len(h) for k, h in enumerate(html)}
    assert {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {3: 1, 6: 1}
    path = warc.scratch_path(spark, "warc-test")
    warc.write_archives(pages, path)
    back = {warc_id: url for warc_id, url in warc.read_archives(spark, path).select("record_id", "url").collect()}
    assert back == {f"<urn:page:{k}>": u.replace("\r", "%0D").replace("\n", "%0A") for k, u in enumerate(urls)}


def test_warc_chains_in_few_rounds(spark, monkeypatch):
    """Reached pieces against following each link, and a long file of whole records without a round for each doubling of its length."""
    r = random.Random(5)
    links = [("plain", 10 * k, 10 * k + 10) for k in range(3000)]
    for file in ("a", "b", "c", "d"):
        at = [-7, 0, *sorted(r.sample(range(1, 400), 120))]
        # Most pieces link to the next one, others further on, backwards, between pieces or nowhere.
        links += [(file, x, r.choice([*at[k + 1 : k + 2]] * 6 + [*at[k + 1 : k + 9], 5, x + 1, None])) for k, x in enumerate(at)]
    following, want = {(f, x): n for f, x, n in links}, set()
    for file in {f for f, _, _ in links}:
        x = 0
        while (file, x) in following:
            want.add((file, x))
            n = following[file, x]
            if n is None or n <= x:
                break
            x = n
    frame = spark.createDataFrame(links, "file string, offset long, next long")
    assert {tuple(x) for x in warc.reachable(frame).collect()} == want
    staged, stage = [], warc.stage_at
    monkeypatch.setattr(warc, "stage_at", lambda df, label: staged.append(label) or stage(df, label))
    assert warc.reachable(frame.where("file = 'plain'")).count() == 3000
    assert len(staged) <= 2


def test_warc_reads_of_different_splits(spark, monkeypatch):
    magic = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    pages = spark.createDataFrame([(k, "u", magic * 3 + "y" * 300 * k) for k in range(8)], "page_id long, url string, html string").coalesce(1)
    setting, pieces, reads = "spark.sql.files.maxPartitionBytes", warc._pieces, []
    before = spark.conf.get(setting)

    def other_splits(*args):
        reads.append(1)
        spark.conf.set(setting, "1m" if len(reads) == 1 else "2k")
        return pieces(*args)

    monkeypatch.setattr(warc, "_pieces", other_splits)
    try:
        got = {r.page_id: r.payload_bytes for r in warc.round_trip(pages).collect()}
    finally:
        spark.conf.set(setting, before)
    assert len(reads) == 2 and got == {k: len(magic) * 3 + 300 * k for k in range(8)}
    read = warc.read_archives
    monkeypatch.setattr(warc, "_pieces", pieces)
    monkeypatch.setattr(warc, "read_archives", lambda *a, **k: read(*a, **k).withColumn("complete", F.lit(False)))
    with pytest.raises(RuntimeError, match="8 records"):
        warc.round_trip(pages)


def test_embeddings(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 16))
    vectors = [list(map(float, v)) for v in base] + [list(map(float, base[k % 5] + 0.07 * r.normal(size=16))) for k in range(40)]
    vectors += [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] * 16, vectors[0], [1.0, 2.0], [2.0, 4.0], [1e300, 2e300]]
    ids = list(range(len(vectors) - 1)) + [7]
    frame = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<double>")
    ok = [v is not None and len(v) > 0 and np.isfinite(v).all() and np.any(np.array(v) != 0) for v in vectors]
    unit = [np.array(v) / np.abs(v).max() if o else None for v, o in zip(vectors, ok)]
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    edges = [(i, j) for i in range(len(ids)) for j in range(i) if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and cos(unit[i], unit[j]) >= 0.95]
    n, root = collections.Counter(x for e in edges for x in e), brute.comps(len(ids), edges)
    low = {}
    for i, x in zip(ids, root):
        low[x] = min(low.get(x, i), i)
    want = [(i, n[k], low[root[k]], i == low[root[k]]) for k, i in enumerate(ids)]
    same([tuple(x) for x in embedding_dups.near_duplicates(frame, block=16).collect()], want)
    assert embedding_dups.near_duplicates(frame.limit(0)).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/1?x#y", "http://x.net/", "http://x.net", "https://example.com/de/", "http://notexample.com/de/", "a://b.ORG/fr/é#/", "http://org?a", "x\n://h.net/p\nq"]
    pages = spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)] + [(3, urls[3], 1)], "page_id long, url string, rule int")
    outcomes = spark.createDataFrame([(3, 1), (7, 0), (7, 1), (None, 1), (99, 0)], "page_id long, good int")
    got = {r.page_id: r for r in url_reputation.judge(pages, outcomes).collect()}
    assert [(got[k].host, got[k].path, got[k].rule) for k in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.net", "/en/1", "example.net/en/"), ("x.net", "/", "net/"), ("x.net", "", None),
        ("example.com", "/de/", "example.com/de/"), ("notexample.com", "/de/", None), ("b.org", "/fr/é", "org/fr/"), ("org", "", None), ("h.net", "/p\nq", "net/"),
    ]
    assert got[3].verdict == "allow" and got[4].verdict == "block" and got[7].verdict in ("allow", "block")
    assert url_reputation.judge(pages.limit(0), outcomes).count() == 0


def test_toxicity(spark, nothing):
    bad, rows = ["idiot", "moron"], []
    for k in range(200):
        words = text(40, 1000 + k).split()
        if k % 4 == 0:
            words[5] = bad[k % 8 // 4]
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    costs, model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    odd = [(900, "1d10t"), (901, "what a m o r o n"), (902, "idiiiiot!"), (903, "i.d.i.o.t"), (904, text(60, 3)), (905, None), (906, ""), (907, "z" * 5000 + " idiot")]
    got = {r.doc_id: r._score for r in toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), costs, model).collect()}
    assert all(got[k] >= 0.5 for k in (900, 901, 902, 903, 907)), got
    assert all(got[k] < 0.5 for k in (904, 905, 906)), got
    empty_costs, empty_model = toxicity.train(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(nothing, empty_costs, empty_model).count() == 0


def test_every_mark_has_a_weight(spark, monkeypatch):
    r = random.Random(3)
    bad = ["".join(r.choice("abcdefghijklmnopqrstuvw") for _ in range(9)) for _ in range(330)]
    lines = [(f"kala {w} mono", 1) for w in bad for _ in range(4)] + [("kala zyx mono", 1)] * 3 + [("kala mono", 0)] * 1500
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(lines)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(lines)], "doc_id long, toxic int")
    asked = spark.createDataFrame([("zyx",), ("mono",), (f"{bad[0]} {bad[1]}",), (None,), (None,)], "text string")

    def scores(costs, model):
        return sorted((r.text or "", round(r._score, 9)) for r in toxicity.score(asked, costs, model).collect())

    costs, model = toxicity.train(docs, labels)
    sent = scores(costs, model)
    assert dict(sent)["zyx"] > dict(sent)["mono"] and len(sent) == 5
    monkeypatch.setattr(toxicity, "SENT_MARKS", 10)
    assert scores(costs, model) == sent
    # Also when the rows that the weights are fitted on do not have the mark.
    monkeypatch.setattr(toxicity, "SAMPLE", 400)
    fewer = dict(scores(*toxicity.train(docs, labels)))
    assert min(fewer["zyx"], fewer[f"{bad[0]} {bad[1]}"]) > fewer["mono"]


def test_sample_by_threshold(spark):
    import hashlib

    rows = [(k % 900, k % 2, [f"w{k}"]) for k in range(3000)] + [(None, 1, ["n"])] * 3
    frame = spark.createDataFrame(rows, "doc_id long, toxic int, words array<string>").repartition(7)
    got = toxicity.sampled(frame, 500).collect()
    order = lambda r: (hashlib.md5(str(r[0]).encode() if r[0] is not None else b"").hexdigest(), r[0] is not None, r[0] or 0, r[1])
    assert sorted(order(tuple(r)) for r in got) == sorted(map(order, rows))[:500]
    assert toxicity.sampled(frame, 5000).count() == len(rows)


def test_restored(spark):
    lines = [f"you are an idiot and an ass number {k} of them all" for k in range(50)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    restore = toxicity.Restorer(toxicity.character_costs(toxicity.character_counts(docs)))
    assert [restore(t) for t in ("@$$", "455", "1 d 1 0 t", "i-d-1-0-t", "an !d10t, an @$$!")] == ["ass", "ass", "idiot", "idiot", "an idiot an ass"]
    assert not restore("# - ?").strip() and restore("it's well-known") == "it s well known"
    assert set(restore("i d i o t " * 60).split()) == {"idiot"}


@pytest.mark.parametrize("item_bytes", [decontaminate.ITEM_BYTES, 200])
def test_decontamination(spark, docs, nothing, item_bytes):
    items = [(1, text(300, 1)[:200]), (2, "One, TWO."), (3, None), (4, "..."), (1, text(25, 60)), (5, text(25, 60)), (None, "x y")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(docs, frame, item_bytes=item_bytes)
    same([tuple(r) for r in got.drop("spans").collect()], brute.op8(corpus(), items))
    hit = got.where("doc_id = 4").first()
    assert hit.spans == [[0, 8]]
    assert decontaminate.report(nothing, frame, item_bytes=item_bytes).count() == 0


def test_token_counts(spark, docs, nothing):
    model = token_counts.model_bytes()
    own = token_counts.load(model)
    got = token_counts.counts(docs, model, chunk=500, overlap=64).collect()
    want = [(d, len((t or "").encode()), len(own.encode(t)) if t else 0) for d, t in corpus()]
    same([tuple(r) for r in got], want)
    assert token_counts.counts(nothing, model).count() == 0


def test_language_id(spark, nothing, monkeypatch):
    words = {"aa": "alpha beta gamma delta", "bb": "uno dos tres cuatro", "cc": "один два три"}
    rows = [(" ".join(random.Random(k).choices(v.split(), k=20)), lang) for lang, v in words.items() for k in range(10)]
    learned = language_id.profiles(spark.createDataFrame([*rows, (None, "aa"), ("x", None)], "text string, lang string"))
    asked = spark.createDataFrame([("ALPHA gamma",), ("dos tres",), ("Два!",), (None,), ("",), ("123 !",), ("alpha " * 30000,)], "text string")
    got = [tuple(r._lang) for r in language_id.predict(asked, learned).collect()]
    assert [g[0] for g in got] == ["aa", "bb", "cc", "und", "und", "und", "aa"] and all(0 <= g[1] <= 1 for g in got)
    assert language_id.predict(nothing, []).count() == 0
    # Profiles that are too many to be sent at once are sent in groups, with the same answers.
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 1)
    many = language_id.profiles(spark.createDataFrame(rows, "text string, lang string"))
    assert many.count() == 3 and [tuple(r._lang) for r in language_id.predict(asked, many).collect()] == got


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, now, FOLDER)
        if name != "mixing":
            assert after.columns == docs.columns
        now = after
    assert 0 < now.count() <= docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    import duckdb

    from tools.check import compare, normalised

    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    cursor = db.execute(queries.ORACLES[name])
    assert compare(normalised(df.columns, [tuple(r) for r in df.collect()]), normalised([c[0] for c in cursor.description], cursor.fetchall())) is None
