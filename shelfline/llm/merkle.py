"""A Merkle manifest of a dataset: one hash tree a group, and one over the groups' roots.

Every 2 consecutive nodes become the hash of their digests, written as hex; a last node without a
partner becomes the hash of itself, for as long as its level has more than one node. Aligned runs of
2^k nodes are therefore complete subtrees, whatever lies around them: a *superblock* is such a run
of ``BLOCK`` nodes.

1. Rows become leaves where they are read; only digests travel. Their places in a group are ranks
   over slabs, so a group of most rows is spread over many tasks.
2. Upwards: each superblock is reduced by itself, its root is a node of the next tier, and so on until
   every group has one node. The groups' roots are the leaves of the last tree, treated alike.
3. Downwards: a tier's superblocks are cogrouped with the outer nodes that their members' proofs
   need, the siblings above the superblock. One ``applyInPandas`` finishes the local reduction, joins
   local siblings and outer nodes to proofs, and hands these down as the outer nodes of the tier
   below. In the tier of the leaves the same step folds a candidate leaf along its proof.

A task holds one superblock. Nothing is collected: a tier has a row for each superblock below it, and
the number of tiers is the logarithm of the largest count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.operators.ordered import global_rank
from shelfline.session import stage_table

#: Levels that one task reduces at a time.
LEVELS = 12
TREES = "trees"  # the group name of the tree over the groups; other names start with "=" or are "null"
OUTER = "tree string, block long, siblings array<string>, sides array<boolean>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hash of the columns' values: ``-`` for null, else byte count, colon, value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def reduce_levels(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of a subtree from its leaves up, ``levels`` of them above the leaves."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return out


def siblings_of(levels: list[list[str]], at: int) -> tuple[list[str | None], list[bool]]:
    """Sibling (or None) and whether it stands to the left, for each level below the top, from leaf ``at`` up."""
    siblings, sides = [], []
    for nodes in levels[:-1]:
        other = at ^ 1
        siblings.append(nodes[other] if other < len(nodes) else None)
        sides.append(other < at)
        at >>= 1
    return siblings, sides


def fold(node: str, siblings: Sequence[str | None], sides: Sequence[bool]) -> str:
    """The root that a leaf and its proof give."""
    for sibling, left in zip(siblings, sides):
        node = digest(node if sibling is None else sibling + node if left else node + sibling)
    return node


def _height(count: Column) -> Column:
    """Levels above ``count`` leaves: the smallest h with 2^h >= count."""
    return F.when(count <= 1, 0).otherwise(F.length(F.conv((count - 1).cast("string"), 10, 2))).cast("int")


def _blocks_up(nodes: DataFrame, step: int) -> DataFrame:
    """Roots of the superblocks of (tree, pos, node, height): the nodes of the next tier."""

    def reduce_block(part: pd.DataFrame) -> pd.DataFrame:
        first = part.iloc[:1]
        levels = min(step, int(first["height"].iloc[0]))
        top = reduce_levels(list(part.sort_values("pos")["node"]), levels)[-1]
        return pd.DataFrame({"tree": first["tree"], "pos": first["block"], "node": top, "height": first["height"] - levels})

    return _blocked(nodes, step).groupBy("tree", "block").applyInPandas(reduce_block, "tree string, pos long, node string, height int")


def _blocked(nodes: DataFrame, step: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", step))


def _outer_down(nodes: DataFrame, outer: DataFrame, step: int) -> DataFrame:
    """Outer nodes of the superblocks below: siblings in this tier's superblock, then those above it."""

    def join_block(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("pos")
        levels = reduce_levels(list(rows["node"]), min(step, int(rows["height"].iloc[0])))
        high, high_sides = list(above["siblings"].iloc[0]), list(above["sides"].iloc[0])
        proofs = [siblings_of(levels, at) for at in range(len(rows))]
        return pd.DataFrame({
            "tree": rows["tree"].to_numpy(), "block": rows["pos"].to_numpy(),
            "siblings": [s + high for s, _ in proofs], "sides": [[bool(x) for x in (*s, *high_sides)] for _, s in proofs],
        })

    return _blocked(nodes, step).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join_block, OUTER)


def _climb(nodes: DataFrame, step: int) -> list[DataFrame]:
    """Tiers of (tree, pos, node, height), from the given one to the one in which every tree is one node."""
    tiers = [nodes]
    while tiers[-1].where("height > 0").limit(1).count():
        # A tree that is down to one node stands at place 0 and is passed on as it is.
        tiers.append(stage_table(_blocks_up(tiers[-1], step), "merkle-tier"))
    return tiers


def _no_outer(tops: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>").alias("siblings"), F.array().cast("array<boolean>").alias("sides")
    return tops.select("tree", F.col("pos").alias("block"), *empty)


def _descend(tiers: list[DataFrame], outer: DataFrame, step: int) -> DataFrame:
    """Outer nodes of the superblocks of the lowest tier, from those of the trees' tops."""
    for nodes in reversed(tiers[1:]):
        outer = stage_table(_outer_down(nodes, outer, step), "merkle-outer")
    return outer


def manifest(leaves: DataFrame, group: str, order: str, candidate: str = "leaf", levels: int = LEVELS, proofs: bool = True) -> DataFrame:
    """``leaves`` with place, subroot, root, proof and the root that ``candidate`` folds to.

    ``leaves`` has a column ``leaf`` of digests, the columns ``group`` and ``order``, and a digest in
    ``candidate``: the leaf that is held against the manifest, by default the leaf itself. The result
    has these and ``place`` (from 0, by ``order`` with null first, ties by leaf), ``subroot``, ``root``,
    ``proof`` (sibling digests from the leaf up; left out unless ``proofs``), ``proof_sha256`` and
    ``folded_root``. Null is a group of its own. Repeated rows are leaves next to each other. An empty
    table gives no rows. Columns of other names are left out.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("null"))
    rows = leaves.select(
        name.alias("tree"), F.col(group).alias("member_of"), F.col(order).alias("member_id"), F.col("leaf").alias("node"), F.col(candidate).alias("held")
    )
    # Ranking reads its input twice; digests are taken once and written.
    rows = stage_table(rows, "merkle-digests")
    ranked = global_rank(rows, [F.col("member_id").asc_nulls_first(), F.col("node"), F.col("held")], "place", keys=["tree"])
    placed = stage_table(ranked.withColumn("pos", F.col("place") - 1).drop("place"), "merkle-leaves")
    heights = placed.groupBy("tree").agg(F.max("member_of").alias("member_of"), _height(F.max("pos") + 1).alias("height"))
    heights = stage_table(heights, "merkle-heights")
    # One row for each group against rows of digests: the planner sends it or shuffles it by its size.
    base = placed.join(heights.select("tree", "height"), "tree")
    tiers = _climb(base.select("tree", "pos", "node", "height"), levels)

    subroots = tiers[-1].select("tree", "node").join(heights, "tree")
    by_name = global_rank(subroots, [F.col("member_of").asc_nulls_first()], "place")
    top = stage_table(by_name.select(F.lit(TREES).alias("of"), (F.col("place") - 1).alias("pos"), "node", "tree"), "merkle-subroots")
    high = top.select(F.col("of").alias("tree"), "pos", "node", _height(F.lit(top.count())).alias("height"))
    high_tiers = _climb(high, levels)
    # The tree over the groups gives each group's outer nodes; its root goes along as one more row's value.
    high_outer = stage_table(_outer_down(high_tiers[0], _descend(high_tiers, _no_outer(high_tiers[-1]), levels), levels), "merkle-outer")
    root = high_tiers[-1].select("node").scalar()
    per_tree = top.join(high_outer.select(F.col("block").alias("pos"), "siblings", "sides"), "pos")
    tops = per_tree.select("tree", F.lit(0).cast("long").alias("block"), "siblings", "sides")
    outer = _descend(tiers, tops, levels)
    known = per_tree.select("tree", F.col("node").alias("subroot"), root.alias("root"))
    known = stage_table(outer.join(known, "tree"), "merkle-outer")

    def finish(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("pos").reset_index(drop=True)
        tree = reduce_levels(list(rows["node"]), min(levels, int(rows["height"].iloc[0])))
        high, high_sides = list(above["siblings"].iloc[0]), list(above["sides"].iloc[0])
        paths = []
        for at in range(len(rows)):
            siblings, sides = siblings_of(tree, at)
            paths.append((siblings + high, sides + high_sides))
        out = rows[["member_of", "member_id", "pos", "node", "held"]].copy()
        out["subroot"], out["root"] = above["subroot"].iloc[0], above["root"].iloc[0]
        shown = [[s for s in siblings if s is not None] for siblings, _ in paths]
        out["proof_sha256"] = [digest("".join(s)) for s in shown]
        out["folded_root"] = [fold(leaf, *path) for leaf, path in zip(rows["held"], paths)]
        if proofs:
            out["proof"] = shown
        return out

    kinds = rows.schema
    given = f"member_of {kinds['member_of'].dataType.simpleString()}, member_id {kinds['member_id'].dataType.simpleString()}"
    schema = f"{given}, pos long, node string, held string, subroot string, root string, proof_sha256 string, folded_root string" + (", proof array<string>" if proofs else "")
    done = _blocked(base, levels).groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInPandas(finish, schema)
    return done.select(
        F.col("member_of").alias(group), F.col("member_id").alias(order), F.col("pos").alias("place"), F.col("node").alias("leaf"),
        F.col("held").alias("candidate"), "subroot", "root", *(["proof"] if proofs else []), "proof_sha256", "folded_root",
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered) of every row of ``documents``.

    ``tampered`` is the leaf of the row with one more in n_chars where 7 divides the crc32 of the id in
    decimals; null counts and null ids stay as they are.
    """
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    hit = F.col("n_chars").isNotNull() & F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    plain = leaf_digest([F.col(f) for f in FIELDS])
    changed = leaf_digest([more if f == "n_chars" else F.col(f) for f in FIELDS])
    return docs.select("doc_id", "lang", plain.alias("leaf"), F.when(hit, changed).otherwise(plain).alias("tampered"))


def document_manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every document held against the manifest after tampering."""
    proven = manifest(document_leaves(docs), "lang", "doc_id", "tampered", levels, proofs=False)
    return proven.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
