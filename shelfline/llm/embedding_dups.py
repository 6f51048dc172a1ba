"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Equal vectors are collapsed first. The rest is dealt into blocks of about ``BLOCK`` rows by a hash;
each pair of blocks is one tile. In a tile the int8 codes are multiplied exactly. For unit vectors
x = s q + e the product x.y differs from s t (q.r) by at most |s q||f| + |e||t r| + |e||f|, so the
norms of the code vectors and of the rounding errors bound every cosine from both sides. Pairs
surely above or below the threshold are decided by the codes; only pairs whose bounds straddle it
are computed again in double precision.

A tile returns one row per vector with its number of links in the tile, and a spanning forest of
the links, never the pairs: a group of copies that holds a third of all rows gives as many rows as
it has members in each tile. Work is quadratic in the number of blocks, as every exact search by
tiles is; memory in a task is two blocks and one strip of products.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.components import connected_components
from shelfline.session import stage_table

THRESHOLD = 0.95
BLOCK = 4096
#: Rows of a tile multiplied at once.
STRIP = 512
#: Slack for the rounding of norms, and for scaling exact sums in float32.
ROUNDING, SCALING = 1e-12, 1e-6


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    # Scaling by the largest component first keeps squares in range.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes as small whole float32 numbers, scales, norms of the code vectors and of the errors."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None])
    coded = codes * scale[:, None]
    norm = lambda v: np.sqrt((v * v).sum(axis=1)) + ROUNDING
    return codes.astype(np.float32), scale, norm(coded), norm(x - coded)


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float):
    """(i, j) of the pairs of rows of x and y at or above the threshold, strip by strip, in the order of i."""
    q, s, qn, qe = quantised(x)
    r, t, rn, re = quantised(y)
    if q.shape[1] * 127 * 127 >= 1 << 24:  # beyond that float32 does not hold every sum of products
        q, r = q.astype(np.float64), r.astype(np.float64)
    widest = (qn.max() * re.max()) + qe.max() * (rn.max() + re.max()) + SCALING
    for start in range(0, len(x), STRIP):
        rows = slice(start, start + STRIP)
        about = q[rows] @ r.T
        about *= t.astype(about.dtype)
        about *= s[rows, None].astype(about.dtype)
        i, j = np.nonzero(about >= threshold - widest)
        value = about[i, j].astype(np.float64)
        i += start
        slack = qn[i] * re[j] + qe[i] * (rn[j] + re[j]) + SCALING
        linked = value - slack >= threshold
        unsure = np.flatnonzero(~linked & (value + slack >= threshold))
        for k in range(0, len(unsure), 100_000):
            part = unsure[k : k + 100_000]
            linked[part] = (x[i[part]] * y[j[part]]).sum(axis=1) >= threshold
        if linked.any():
            yield i[linked], j[linked]


def tile(left_id: np.ndarray, x: np.ndarray, right_id: np.ndarray, y: np.ndarray, left_n: np.ndarray, right_n: np.ndarray, threshold: float, same: bool) -> pd.DataFrame:
    """Rows (a, b, n): for a = b the number of rows that a links to, else a spanning edge with n = 0."""
    left, right = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    edges: list[tuple[int, int]] = []
    owner = np.full(len(y), -1, np.int64)
    for i, j in linked_pairs(x, y, threshold):
        if same:
            apart = i != j
            i, j = i[apart], j[apart]
        left += np.bincount(i, right_n[j], len(x)).astype(np.int64)
        right += np.bincount(j, left_n[i], len(y)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(i)) + 1
        for row, columns in zip(i[np.concatenate(([0], cuts))] if len(i) else (), np.split(j, cuts)):
            # A row joins the earlier rows that own its columns, and the columns that no row owns yet.
            owners = owner[columns]
            edges.extend((int(left_id[row]), int(left_id[o])) for o in np.unique(owners[owners >= 0]))
            edges.extend((int(left_id[row]), int(right_id[c])) for c in columns[owners < 0])
            owner[columns] = row
    counts = [(left_id, left)] if same else [(left_id, left), (right_id, right)]
    out = [pd.DataFrame({"a": ids, "b": ids, "n": n})[n > 0] for ids, n in counts]
    found = pd.DataFrame(edges, columns=["a", "b"], dtype="int64").drop_duplicates().assign(n=0)
    return pd.concat([*out, found[found["a"] != found["b"]]])


def usable(column: str = "embedding"):
    """Not null, no null or non-finite component, not all zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(math.inf))
    return F.coalesce(F.forall(column, finite), F.lit(False)) & F.coalesce(F.exists(column, lambda v: v != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Each row is a vector: repeated rows link to each other. Vectors that are null, empty, zero or hold a
    null or non-finite component link with nothing and are kept. Vectors of different lengths do not
    link. Rows without id take part in counts and links but have no component or kept of their own.
    """
    rows = vectors.select("vec_id", "embedding").withColumn("_ok", usable())
    # Collapse by value, with the plain hash of the components as the key that travels.
    key = F.struct(F.xxhash64("embedding").alias("x"), F.hash("embedding").alias("y"), F.size("embedding").alias("d"))
    keyed = rows.withColumn("_key", F.when(F.col("_ok"), key))
    classes = keyed.where("_ok").groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"), F.first("embedding").alias("embedding"))
    classes = stage_table(classes.select("_key", F.xxhash64("_key").alias("node"), "n", "first_id", "embedding", F.col("_key.d").alias("d")), "vector-classes")
    tiles = stage_table(_tiles(classes, threshold, block), "vector-tiles")
    linked = tiles.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    parts = connected_components(tiles.where("a <> b").select("a", "b"))
    placed = classes.select("_key", "node", "n", "first_id").join(linked, "node", "left").join(parts, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    placed = placed.join(smallest, "component").select("_key", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    joined = keyed.select("vec_id", "_key").join(placed, "_key", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _tiles(classes: DataFrame, threshold: float, block: int) -> DataFrame:
    sizes = classes.groupBy("d").count().collect()  # one row for each vector length
    out = None
    for size in sizes or [{"d": 1, "count": 0}]:
        one = _tiles_of_length(classes.where(F.col("d") == size["d"]), size["count"], threshold, block)
        out = one if out is None else out.unionByName(one)
    return out


def _tiles_of_length(classes: DataFrame, count: int, threshold: float, block: int) -> DataFrame:
    blocks = max(1, math.ceil(count / block))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        x = np.array([np.asarray(v) for v in part["embedding"]])
        return pd.DataFrame(
            {"block": part["block"].iloc[:1], "ids": [part["node"].to_numpy(np.int64).tobytes()], "n": [part["n"].to_numpy(np.int64).tobytes()], "data": [x.astype(x.dtype.newbyteorder("<")).tobytes()], "kind": [x.dtype.str], "rows": [len(x)]}
        )

    def unpack(row):
        x = np.frombuffer(row.data, row.kind).reshape(row.rows, -1)
        return np.frombuffer(row.ids, np.int64), unit_rows(list(x)), np.frombuffer(row.n, np.int64)

    def product(pair: pd.DataFrame) -> pd.DataFrame:
        rows = list(pair.sort_values("block").itertuples())
        a = unpack(rows[0])
        b = a if len(rows) == 1 else unpack(rows[1])
        return tile(a[0], a[1], b[0], b[1], a[2], b[2], threshold, len(rows) == 1)

    dealt = classes.select("node", "n", "embedding", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    packed = dealt.groupBy("block").applyInPandas(pack, "block int, ids binary, n binary, data binary, kind string, rows long")
    # Block b meets every block c: the tile (min, max) gets one row from each, the tile (b, b) one row.
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    ends = packed.select("*", others).select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return ends.groupBy("low", "high").applyInPandas(product, "a long, b long, n long")
