"""Hard-negative mining by exact top-k search in a tree of split points (a GNAT).

A node of the tree has up to ``FANOUT`` split points; a row belongs to the nearest one, that is, to a
cell bounded by the hyperplanes between split points. For every pair (i, j) of them the node stores
the range of the distances from split point i to all rows below split point j, and for every j the
range of squared norms there.

A search asks for the best rows by inner product within windows of scores. For vectors a and x,
a.x = (|a|^2 + |x|^2 - d(a, x)^2) / 2, so with the norms below j a window of scores is an annulus of
distances around the anchor. The distances from the anchor to the split points give, by the
triangle inequality, a range that every row below j lies in; j is eliminated when no window's annulus
meets it. What is left are leaves, which are compared exactly in integers.

The split points are fitted on a bounded sample of rows (``SAMPLE``); the ranges are taken over all
rows, so results are exact whatever the sample is. The tree has at most ``FANOUT`` ** ``DEPTH`` leaves
and is sent to the tasks. Leaves are cut into parts of about ``PART`` rows, anchors into blocks of
about ``BLOCK``; a task holds one part and one block, and answers with at most k rows for each
window. Each search first looks only into the anchors' own leaves, which raises the lower ends of the
windows to the k-th score found there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.session import stage_table

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW_PERCENT = 80
FANOUT, DEPTH = 8, 3
#: About so many rows are drawn to choose split points; never more than twice this many.
SAMPLE = 16_384
PART, BLOCK = 4096, 1024
#: Anchors of a block compared at once.
STRIP = 64
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
#: Squared norms up to here keep every score within a long.
MOST_NORM = 1 << 62


def whole_rows(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, vector): the rows that take part, with vector = floor(256 x) in whole doubles."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).where(finite)
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), vector.alias("vector"))
    short = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x) <= F.lit(float(MOST_NORM))
    return rows.where(short).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector")


def matrix(vectors) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in vectors], dtype=np.float64).reshape(len(vectors), -1)


def packed(rows: np.ndarray) -> tuple[bytes, str]:
    """Bytes of whole numbers in the narrowest type that holds them."""
    top = np.abs(rows).max(initial=0)
    kind = next(k for k, bound in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<f8", math.inf)) if top < bound)
    return rows.astype(kind).tobytes(), kind


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole doubles, as longs."""
    longest = math.sqrt(float((a * a).sum(1).max(initial=0)) * float((b * b).sum(1).max(initial=0)))
    # Partial sums are bounded by the product of norms, too: below 2^53 doubles hold each of them.
    if longest < 1 << 52:
        return np.rint(a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def squared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between rows, with room for rounding."""
    n, m = (a * a).sum(1)[:, None], (b * b).sum(1)[None, :]
    about, slack = n + m - 2 * (a @ b.T), (n + m) * (1e-15 * (a.shape[1] + 8)) + 1e-9
    return np.maximum(about - slack, 0), np.maximum(about, 0) + slack


class Node:
    """Split points of one cell; ``children[j]`` is the node below split point j, or the number of a leaf."""

    def __init__(self, number: int, points: np.ndarray):
        self.number, self.points, self.children = number, points, []
        k = len(points)
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        self.norm_low, self.norm_high = np.full(k, np.inf), np.full(k, -np.inf)

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        return ((self.points * self.points).sum(1)[None, :] - 2 * (rows @ self.points.T)).argmin(1)


def split_points(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is farthest from those taken."""
    chosen, apart = [0], squared(rows, rows[:1])[0][:, 0]
    while len(chosen) < count:
        at = int(apart.argmax())
        if apart[at] <= 0:
            break
        chosen.append(at)
        apart = np.minimum(apart, squared(rows, rows[at : at + 1])[0][:, 0])
    return rows[chosen]


class Tree:
    """Nodes over one length of vectors. Without a second distinct row the whole tree is leaf 0."""

    def __init__(self, sample: np.ndarray, stop: int, fanout: int = FANOUT, depth: int = DEPTH):
        self.nodes: list[Node] = []
        self.leaves = 0
        self.root = self._grow(sample, stop, fanout, depth)

    def _grow(self, rows: np.ndarray, stop: int, fanout: int, depth: int):
        points = split_points(rows, fanout) if depth and len(rows) > stop else rows[:1]
        if len(points) < 2:
            self.leaves += 1
            return self.leaves - 1
        node = Node(len(self.nodes), points)
        self.nodes.append(node)
        cell = node.nearest(rows)
        node.children = [self._grow(rows[cell == j], stop, fanout, depth - 1) for j in range(len(points))]
        return node

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.int32)
        for node, where, _ in self._walk(rows):
            for j, child in enumerate(node.children):
                if not isinstance(child, Node):
                    out[where[0][where[1] == j]] = child
        return out

    def _walk(self, rows: np.ndarray):
        """Each node with the rows in its cell and the child of each, and their matrix."""
        todo = [(self.root, np.arange(len(rows)))] if isinstance(self.root, Node) else []
        while todo:
            node, at = todo.pop()
            own = rows[at]
            cell = node.nearest(own) if len(at) else np.empty(0, int)
            yield node, (at, cell), own
            todo.extend((child, at[cell == j]) for j, child in enumerate(node.children) if isinstance(child, Node))

    def ranges(self, rows: np.ndarray) -> Iterator[tuple]:
        """(node, i, j, low, high): bounds of squared distances from point i to the rows below j; i = -1 bounds squared norms."""
        for node, (_, cell), own in self._walk(rows):
            if not len(own):
                continue
            low, high = squared(node.points, own)
            norms = (own * own).sum(1)
            for j in np.unique(cell):
                below = cell == j
                yield node.number, -1, int(j), float(norms[below].min()), float(norms[below].max())
                for i, (a, b) in enumerate(zip(low[:, below].min(1), high[:, below].max(1))):
                    yield node.number, i, int(j), float(a), float(b)

    def set_ranges(self, rows) -> None:
        for number, i, j, low, high in rows:
            node = self.nodes[number]
            if i < 0:
                node.norm_low[j], node.norm_high[j] = low * (1 - 1e-12), high * (1 + 1e-12)
            else:
                node.low[i, j], node.high[i, j] = math.sqrt(low), math.sqrt(high)

    def open_leaves(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Leaves that may hold a row in a window (low, high: anchors x windows) with the anchors that must look there."""
        if not isinstance(self.root, Node):
            return [(self.root, np.arange(len(anchors)))]
        out, todo = [], [(self.root, np.arange(len(anchors)))]
        while todo:
            node, at = todo.pop()
            own = anchors[at]
            near, far = (np.sqrt(x) for x in squared(own, node.points))
            norm = (own * own).sum(1)
            for j, child in enumerate(node.children):
                if node.norm_high[j] < 0:  # no row lies below
                    continue
                least = np.maximum(np.maximum(near - node.high[:, j], node.low[:, j] - far).max(1), 0)
                most = (far + node.high[:, j]).min(1)
                # The annulus of a window against the range of distances below j, both squared.
                inner = norm[:, None] + node.norm_low[j] - 2 * high[at]
                outer = norm[:, None] + node.norm_high[j] - 2 * low[at]
                slack = 1e-9 * (norm + node.norm_high[j] + 1)[:, None]
                alive = at[((inner <= (most * most)[:, None] + slack) & (outer >= (least * least)[:, None] - slack)).any(1)]
                if len(alive):
                    todo.append((child, alive)) if isinstance(child, Node) else out.append((child, alive))
        return out


ROWS = "row long, vec_id long, label long, vector array<double>, leaf int"


class Index:
    """Rows with their leaves (staged), the tree, and the number of rows in each leaf."""

    def __init__(self, rows: DataFrame, fanout: int = FANOUT, depth: int = DEPTH, sample: int = SAMPLE, part: int = PART):
        """``rows``: row (a unique long), vec_id, label, vector of whole doubles, all of one length."""
        spark = rows.sparkSession
        count = rows.count()
        chance = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, sample / max(count, 1)))
        drawn = [r[0] for r in rows.where(chance).select("vector").limit(2 * sample).collect()]
        tree = Tree(np.unique(matrix(drawn), axis=0) if drawn else np.zeros((1, 1)), max(1, int(len(drawn) * part / max(count, 1))), fanout, depth)
        sent = spark.sparkContext.broadcast(tree)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(leaf=sent.value.leaf_of(matrix(batch["vector"])))

        self.rows = stage_table(rows.select("row", "vec_id", "label", "vector").mapInPandas(place, ROWS), "gnat-rows")

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield pd.DataFrame(list(sent.value.ranges(matrix(batch["vector"]))), columns=["node", "i", "j", "low", "high"])

        found = self.rows.select("vector").mapInPandas(measure, "node int, i int, j int, low double, high double")
        # At most fanout + 1 rows for each of the tree's edges, whose number has a bound.
        tree.set_ranges(tuple(r) for r in found.groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect())
        sent.unpersist()
        self.tree = spark.sparkContext.broadcast(tree)
        self.sizes = {r["leaf"]: r["count"] for r in self.rows.groupBy("leaf").count().collect()}
        self.parts = {leaf: math.ceil(n / part) for leaf, n in self.sizes.items()}
        many = F.create_map(*[F.lit(x) for leaf, n in self.parts.items() for x in (leaf, n)]) if self.parts else F.create_map(F.lit(0), F.lit(1))
        cut = F.pmod(F.xxhash64("row"), many[F.col("leaf")]).cast("int")
        self.packs = stage_table(self.rows.withColumn("part", cut).groupBy("leaf", "part").applyInPandas(pack_rows, PACK), "gnat-leaves")


PACK = "leaf int, part int, ids binary, names binary, labels binary, data binary, kind string"


def pack_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """A part of a leaf in one row, in the order of ids."""
    rows = rows.sort_values(["vec_id", "row"])
    data, kind = packed(matrix(rows["vector"]))
    whole = lambda c: [rows[c].to_numpy("<i8").tobytes()]
    return pd.DataFrame({"leaf": rows["leaf"].iloc[:1].to_numpy(), "part": rows["part"].iloc[:1].to_numpy(), "ids": whole("row"), "names": whole("vec_id"), "labels": whole("label"), "data": [data], "kind": [kind]})


PACKET = "block long, leaf int, ids binary, labels binary, data binary, kind string, low binary, high binary, windows int"


def packet(block: int, leaf: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
    data, kind = packed(vectors)
    whole = (x.astype("<i8").tobytes() for x in (ids, labels, low, high))
    ids, labels, low_bytes, high_bytes = whole
    return block, leaf, ids, labels, data, kind, low_bytes, high_bytes, low.shape[1]


def window_bounds(windows) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends, anchors x windows; what an anchor lacks is an empty window."""
    width = max(1, max(len(w) for w in windows))
    low, high = np.full((len(windows), width), HIGHEST, np.int64), np.full((len(windows), width), LOWEST, np.int64)
    for i, own in enumerate(windows):
        for j, w in enumerate(own):
            low[i, j], high[i, j] = w["low"], w["high"]
    return low, high


def compare(asked: pd.DataFrame, part: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """The best k rows of a part for every anchor and window of a packet: (row, place, vec_id, score, other)."""
    q, p = next(asked.itertuples()), next(part.itertuples())
    whole = lambda data: np.frombuffer(data, "<i8")
    ids, labels, other_ids, names, other_labels = (whole(x) for x in (q.ids, q.labels, p.ids, p.names, p.labels))
    anchors, rows = (np.frombuffer(x.data, x.kind).reshape(n, -1).astype(np.float64) for x, n in ((q, len(ids)), (p, len(other_ids))))
    low, high = (whole(x).reshape(len(ids), -1) for x in (q.low, q.high))
    found = []
    for start in range(0, len(ids), STRIP):
        strip = slice(start, start + STRIP)
        value = scores(anchors[strip], rows)
        fits = labels[strip, None] == other_labels
        fits = fits & (ids[strip, None] != other_ids) if same else ~fits
        for w in range(q.windows):
            inside = fits & (value >= low[strip, w, None]) & (value <= high[strip, w, None])
            if not inside.any():
                continue
            held = np.where(inside, value, LOWEST)
            if held.shape[1] > k:  # below the k-th largest of its row, ties left in
                inside &= held >= np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k, None]
            i, j = np.nonzero(inside)
            order = np.lexsort((j, -value[i, j], i))  # rows stand in the order of ids
            i, j = i[order], j[order]
            first = np.searchsorted(i, i)
            best = np.arange(len(i)) - first < k
            i, j = i[best], j[best]
            found.append(pd.DataFrame({"row": ids[strip][i], "place": np.full(len(i), w, np.int32), "vec_id": names[j], "score": value[i, j], "other": other_ids[j]}))
    return pd.concat(found) if found else compare_nothing()


def _best(index: Index, anchors: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
    """(row, place, rank, vec_id, score) for anchors (row, label, vector, leaf, windows), from their own leaf only or from all leaves left open."""
    counts = {r["leaf"]: r["count"] for r in anchors.groupBy("leaf").count().collect()}
    before, starts = 0, {}
    for leaf in sorted(counts):
        starts[leaf] = (before, counts[leaf])
        before += counts[leaf]
    # Anchors of one leaf stand together in as few blocks as their number needs.
    start = F.create_map(*[F.lit(float(x)) for leaf, (first, _) in starts.items() for x in (leaf, first)]) if starts else F.create_map(F.lit(0.0), F.lit(0.0))
    size = F.create_map(*[F.lit(float(x)) for leaf, (_, n) in starts.items() for x in (leaf, n)]) if starts else F.create_map(F.lit(0.0), F.lit(0.0))
    leaf, spread = F.col("leaf").cast("double"), F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    block = F.floor((start[leaf] + spread * size[leaf]) / BLOCK).alias("block")
    sent, parts = index.tree, index.parts

    def open_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        vectors, (low, high) = matrix(rows["vector"]), window_bounds(list(rows["windows"]))
        ids, labels, leaves = (rows[c].to_numpy(np.int64) for c in ("row", "label", "leaf"))
        opened = [(own, np.flatnonzero(leaves == own)) for own in np.unique(leaves)] if home else sent.value.open_leaves(vectors, low.astype(float), high.astype(float))
        number = int(rows["block"].iloc[0])
        out = [packet(number, int(own), ids[at], labels[at], vectors[at], low[at], high[at]) for own, at in opened if int(own) in parts]
        return pd.DataFrame(out, columns=[c.split()[0] for c in PACKET.split(", ")])

    opened = anchors.select("row", "label", "vector", "leaf", "windows", block).groupBy("block").applyInPandas(open_block, PACKET)
    many = F.create_map(*[F.lit(x) for own, n in parts.items() for x in (own, n)]) if parts else F.create_map(F.lit(0), F.lit(1))
    packets = stage_table(opened.withColumn("part", F.explode(F.sequence(F.lit(0), many[F.col("leaf")] - 1))), "gnat-packets")
    tiles = index.packs.join(packets.select("leaf", "part", F.col("block").alias("tile")), ["leaf", "part"])

    def task(asked: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        return compare(asked, part, k, same) if len(asked) and len(part) else compare_nothing()

    found = packets.groupBy("leaf", "part", "block").cogroup(tiles.groupBy("leaf", "part", "tile")).applyInPandas(task, "row long, place int, vec_id long, score long, other long")
    spec = Window.partitionBy("row", "place").orderBy(F.col("score").desc(), "vec_id", "other")
    ranked = found.withColumn("rank", F.row_number().over(spec)).where(F.col("rank") <= k)
    return stage_table(ranked.select("row", "place", "rank", "vec_id", "score"), "gnat-best")


def compare_nothing() -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("row", "place", "vec_id", "score", "other")})


def search(index: Index, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(row, place, rank, vec_id, score): the first k rows in each window of each anchor, higher scores first, ties by smaller vec_id.

    ``anchors``: row, label, vector, leaf and ``windows``, an array of (low, high), ends included;
    ``same`` asks for other rows of the anchor's label, else for rows of other labels.
    """
    near = _best(index, anchors, k, same, home=True)
    full = near.groupBy("row", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    raised = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("least"))
    narrowed = F.transform("windows", lambda w, i: F.struct(F.greatest(w["low"], F.coalesce(F.col("least")[i], w["low"])).alias("low"), w["high"].alias("high")))
    asked = anchors.join(raised, "row", "left").withColumn("windows", narrowed).drop("least")
    return _best(index, asked, k, same, home=False)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT, **tree) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label).

    Anchors are the rows whose vec_id ``every`` divides. An anchor's positives are its best other rows of
    its label; for each, the best rows of other labels whose score lies between ``low_percent`` of the
    positive's score and that score are its hard negatives. Scores are inner products of floor(256 x).

    Rows with a null id or label, a null vector or a null or non-finite component take no part, nor do
    vectors whose squared norm exceeds 2^62, as no long holds their scores. Vectors meet vectors of their
    own length; empty ones score 0. Repeated rows are rows of their own: each is an anchor, and they are
    positives of each other. A negative positive score has an empty window. An empty table gives no rows.
    ``tree`` goes to :class:`Index`.
    """
    spark = vectors.sparkSession
    rows = stage_table(whole_rows(vectors.select("vec_id", "embedding", "label")), "mining-rows")
    out = None
    for size in [r[0] for r in rows.select(F.size("vector")).distinct().collect()]:  # one row for each vector length
        one = _mine_length(rows.where(F.size("vector") == size), every, positives, negatives, low_percent, tree)
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], RESULT) if out is None else out


def _mine_length(rows: DataFrame, every: int, positives: int, negatives: int, low_percent: int, tree: dict) -> DataFrame:
    index = Index(rows, **tree)
    anchors = stage_table(index.rows.where(F.col("vec_id") % every == 0), "mining-anchors")
    everything = F.array(F.struct(F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    best = search(index, anchors.withColumn("windows", everything), positives, same=True)
    best = best.select("row", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low = F.ceil(F.col("positive_score").cast("decimal(20,0)") * low_percent / 100).cast("long")
    own = F.sort_array(F.collect_list(F.struct("place", low.alias("low"), F.col("positive_score").alias("high"))))
    windows = best.groupBy("row").agg(F.transform(own, lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("windows"))
    worst = search(index, anchors.join(windows, "row"), negatives, same=False)
    named = worst.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(best, ["row", "place"])
    named = named.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
