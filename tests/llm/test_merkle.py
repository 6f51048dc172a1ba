"""The manifest against a plain walk over whole levels, with superblocks of 4 nodes so that several tiers meet."""

import hashlib
import zlib

import pytest

from shelfline.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def walk(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = walk([leaf(r) for r in groups[g]])
    top = walk([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            changed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                changed[3] += 1
            node, proof = leaf(changed), []
            for levels, at in ((trees[g], i), (top, place)):
                for nodes in levels[:-1]:
                    run = nodes[at // 2 * 2 : at // 2 * 2 + 2]
                    proof += [n for k, n in enumerate(run) if k != at % 2]
                    run[at % 2] = node
                    node, at = sha("".join(run)), at // 2
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], sha("".join(proof)), node, node == top[-1][0]))
    return out


ROWS = [(k, f"s{k % 3}", "en", k, f"text {k}") for k in range(75)]
ROWS += [(k, "s", f"l{k}", None if k % 2 else k, "é" * k) for k in range(80, 97)]
ROWS += [(1, None, None, None, None), (None, "s", "en", 5, ""), (None, "s", "en", 5, ""), (7, "s", "en", 1, "b"), (7, "s", "en", 1, "a"), (200, "s", "é", (1 << 63) - 1, "x" * 100_000), (201, "s", "", -5, "\n")]


@pytest.fixture
def documents(spark):
    rows = [(*r, "own") for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, root string")


@pytest.mark.parametrize("levels", [2, 3, 12])
def test_manifest(documents, levels):
    got = [tuple(r) for r in merkle.document_manifest(documents, levels).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(ROWS)))
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [[], ROWS[:1], ROWS[:2], ROWS[80:81] + ROWS[:1]])
def test_few_rows(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(repr, (tuple(r) for r in merkle.document_manifest(frame, 2).collect()))) == sorted(map(repr, brute(rows)))


def test_proofs_fold_to_the_root(documents):
    leaves = documents.select("lang", "doc_id", merkle.leaf_digest([documents.text]).alias("leaf"))
    for r in merkle.manifest(leaves, "lang", "doc_id", levels=2).collect():
        assert r.folded_root == r.root and r.candidate == r.leaf and sha("".join(r.proof)) == r.proof_sha256
