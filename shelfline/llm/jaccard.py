"""Exact n-gram Jaccard join by a token-group matrix, giving connected components.

1. A text's distinct shingles are 64-bit hashes; equal sets are one *class* from here on.
2. Sorted by hash, the first tokens of two sets that reach the threshold share a guaranteed number
   of tokens (prefix filtering with slack). Prefix tokens that only one class has are dropped, and
   of the rest each class may drop as many of the most frequent as the slack allows. A passage
   that many unrelated documents share goes away here; most classes have nothing left.
3. *Groups*: classes with the same most frequent kept token are similar; they are dealt into groups of
   bounded size. The union of the kept tokens of a group's members is its row in the matrix.
4. Groups are opened for their own members first, then for one class of each component found so far,
   level by level. Dense groups of copies have become single components by then. The stars of the
   components stand for the links that made them, so each level starts from what the last has found.
5. Classes that are still apart are queries. Tokens whose classes are all one component are dropped,
   and so are classes with too few shingles in other components; then the matrix gives each query's
   overlap with the union of each group of another component. Only groups that reach the query's
   bound are opened for it, in bounded parts, and similarity is computed over whole sets.

Links inside one component are not searched for again, so copies are never expanded into pairs.
Nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import drop_staged, raw_words, stage_at, with_small
from shelfline.llm.components import connected_components
from shelfline.session import stage_table

SHINGLE = 4
PERCENT = 85
#: Slack of the prefix in per cent of the set.
SLACK = 6
#: Members, or queries, and their shingles that one opened group may hold.
MEMBERS, TOKENS = 512, 400_000
#: A component of so many classes gets groups of its own for the last round.
ALONE = 32


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, no words none."""
    words = raw_words(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words), seed=len(words))], np.uint64)
    h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.sort(total ^ (total >> np.uint64(32)))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def needed(n: int, percent: int) -> int:
    """Least number of shingles that a set of n shares with any set it links to; also the least size of that set."""
    return -(-percent * n // 100)


def slack(n: int) -> int:
    return max(1, n * SLACK // 100)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - needed(n, percent) + slack(n))


def spare(n: int, percent: int) -> int:
    """One less than the number of prefix tokens that a set of n shares with any partner.

    So many of its most frequent prefix tokens a set may ignore and still share one. Sets ignore half of
    them, and a partner then shares the other half and one more: the bound that a group must reach.
    """
    return slack(needed(n, percent)) - 1


def _profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                s = shingle_set(text, width)
                raw = s.tobytes()
                one, two = (np.uint64(xxhash.xxh3_64_intdigest(raw, seed=k)).astype(np.int64) for k in (0, 1))
                cut = s[: prefix_length(len(s), percent)].view(np.int64)
                out.append((doc_id, text_hash, len(s), one, two, spare(len(s), percent) if len(s) else 0, cut))
            frame = pd.DataFrame(out, columns=["doc_id", "text_hash", "n", "node", "other", "spare", "prefix"])
            yield frame.assign(doc_id=pd.array(batch["doc_id"], "Int64"))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInPandas(profile, "doc_id long, text_hash long, n long, node long, other long, spare int, prefix array<long>")


def components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) for every row of (doc_id, text).

    component_id is the smallest doc_id that links reach. Null, empty and blank texts have no
    shingles and are their own component. Rows with equal sets are linked, also those of one doc_id;
    a row without id takes its component's id, null when no row of it has one.
    """
    return _components(docs, width, percent).drop("part")


def _components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """As :func:`components`, with ``part``, a name of the component that is null only without shingles."""
    spark = docs.sparkSession
    wide, wide_path = stage_at(_profiles(docs, width, percent), "profiles")
    profiles = stage_table(wide.drop("prefix", "other", "spare"), "profiles")
    rep = F.min(F.struct("doc_id", "text_hash")).alias("rep")
    classes = wide.where("n > 0").groupBy("node", "other").agg(rep, F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("spare").alias("spare"), F.first("prefix").alias("prefix"))
    classes, classes_path = stage_at(classes, "classes")
    drop_staged(spark, wide_path)
    kept = stage_table(_kept(classes), "kept-tokens")
    drop_staged(spark, classes_path)
    texts = stage_table(_texts(docs, kept), "class-texts")
    edges = stage_table(_links(kept, texts, width, percent), "links")
    parts = connected_components(edges)
    placed = profiles.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(parts, "node", "left")
    placed = placed.select("node", "low", F.coalesce("component", "node").alias("part"))
    smallest = placed.groupBy("part").agg(F.min("low").alias("component_id"))
    placed = placed.join(smallest, "part").select("node", "component_id", "part")
    joined = profiles.select("doc_id", "text_hash", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(placed, "node", "left")
    return joined.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "part")


def _kept(classes: DataFrame) -> DataFrame:
    """(node, rep, n, need, tokens): prefix tokens shared with other classes, rarest first, without those that are ignored."""
    rows = classes.select("node", F.explode("prefix").alias("token"))
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    found = rows.join(shared, "token")
    lists = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("all"))
    ignored = F.floor(F.col("spare") / 2).cast("int")
    facts = classes.select("node", "rep", "n", ignored.alias("ignored"), (F.col("spare") - ignored + 1).alias("need"))
    left = F.size("all") - F.col("ignored")
    return lists.join(facts, "node").where(left >= F.col("need")).select("node", "rep", "n", "need", F.slice("all", F.lit(1), left).alias("tokens"))


def _texts(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(node, text) of the classes that kept a token: one text each."""
    wanted = kept.select("node", F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("text_hash"))
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    found = with_small(hashed, wanted, "text_hash").where("doc_id <=> _id")
    # Rows of one id and text are the same text; which of them is taken does not matter.
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _parts(rows: DataFrame, keys: list[str], members: int) -> DataFrame:
    """Adds ``part``: rows (keys, node, n) dealt by hash so that a part has about ``members`` rows and ``TOKENS`` shingles."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.greatest(F.count(F.lit(1)) / members, F.sum("n") / TOKENS)).alias("parts"))
    return rows.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts"))).drop("parts")


def _links(kept: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) between classes whose components are those of all links."""
    home = F.element_at("tokens", -1)["token"].alias("home")
    members = stage_table(_parts(kept.select("node", "n", home), ["home"], MEMBERS), "groups")

    def opened(rows: DataFrame, label: str) -> DataFrame:
        """Links of rows (home, part, chunk, node, part_of, query) inside each (home, part, chunk)."""
        full = with_small(texts, rows, "node")
        return stage_table(full.groupBy("home", "part", "chunk").applyInPandas(_opener(width, percent), "a long, b long"), label)

    zero = F.lit(0).cast("long")
    edges = opened(members.select("home", "part", zero.alias("chunk"), "node", F.col("node").alias("part_of"), F.lit(False).alias("query")), "own-links")
    leaders = None
    while True:
        # From here on the stars of the components stand for the links that made them.
        found = connected_components(edges)
        parts = stage_table(_part_of(members, found), "parts")
        edges = found.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b")
        # One class of each component and home meets those of the home's other groups.
        heads = parts.groupBy("home", "part_of").agg(F.min(F.struct("node", "n")).alias("h")).select("home", "part_of", "h.node", "h.n")
        several = heads.groupBy("home").count().where("count > 1").select("home")
        heads = stage_table(heads.join(several, "home", "left_semi"), "heads")
        count = heads.count()
        if not count or count == leaders:
            break
        leaders = count
        dealt = _parts(heads, ["home"], MEMBERS)
        more = opened(dealt.select("home", "part", zero.alias("chunk"), "node", "part_of", F.lit(False).alias("query")), "head-links")
        if not more.take(1):
            break
        edges = edges.unionByName(more)
    return edges.unionByName(opened(_queries(kept, parts, texts, width, percent), "query-links"))


def _part_of(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found, "node", "left").select("home", "part", "node", "n", F.coalesce("component", "node").alias("part_of"))


def _queries(kept: DataFrame, parts: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows (home, part, chunk, ...) of the groups that must be opened for query classes, members and queries, in bounded chunks."""
    sizes = parts.groupBy("part_of").agg(F.count(F.lit(1)).alias("size"))
    tokens = kept.select("node", "need", F.explode("tokens.token").alias("token")).join(parts.select("node", "n", "home", "part_of"), "node").join(sizes, "part_of")
    tokens = _between_components(tokens, ["token"])
    tokens = stage_table(tokens, "open-tokens")
    tokens = _without_hopeless(tokens, texts, width, percent)
    # Groups anew, of classes that are still open: one component each when it is large, else mixed.
    alone = F.when(F.col("size") >= ALONE, F.col("part_of")).otherwise(0)
    order = F.struct(F.when(alone != 0, F.col("size")).otherwise(0).alias("size"), alone.alias("alone"), F.xxhash64("home", alone, "part").alias("group"))
    nodes = tokens.select("node", "n", "home", "part_of", "size").distinct()
    nodes = stage_table(_parts(nodes.withColumn("alone", alone), ["home", "alone"], MEMBERS).select("node", "n", "home", "part_of", order.alias("group")), "groups")
    tokens = tokens.select("token", "node", "need").join(nodes, "node")
    # The matrix: the groups in which a token occurs. A class asks the groups behind its own.
    union = tokens.select("token", F.col("group").alias("theirs")).distinct()
    met = tokens.select("token", "node", "need", "n", "part_of", "group").join(union, "token").where("group < theirs AND NOT (group.alone = theirs.alone AND group.alone <> 0)")
    # The bound: a group whose union shares fewer tokens with the query holds no partner of it.
    overlap = met.groupBy("theirs", "node", "n", "part_of", "need").agg(F.count(F.lit(1)).alias("overlap"))
    met = overlap.where("overlap >= need").select(F.col("theirs").alias("group"), "node", "n", "part_of")
    chunks = met.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / MEMBERS, F.sum("n") / TOKENS)).alias("chunks"))
    met = stage_table(met.join(chunks, "group").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(11)), F.col("chunks"))), "met")
    asked = met.select("group", "chunk").distinct()
    own = nodes.join(asked, "group").select("group", "chunk", "node", "part_of", F.lit(False).alias("query"))
    mixed = nodes.where("group.alone = 0").select("group", F.lit(-1).cast("long").alias("chunk"), "node", "part_of", F.lit(False).alias("query"))
    rows = own.unionByName(mixed).unionByName(met.select("group", "chunk", "node", "part_of", F.lit(True).alias("query")))
    return rows.select(F.lit(0).cast("long").alias("home"), F.col("group.group").alias("part"), "chunk", "node", "part_of", "query")


def _between_components(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose token occurs in several components; the others link nothing new."""
    several = rows.groupBy(*keys).agg(F.min("part_of").alias("l"), F.max("part_of").alias("h")).where("l < h").select(*keys)
    return rows.join(several, keys, "left_semi")


def _without_hopeless(tokens: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The same bound over whole sets: enough of a class's shingles must occur in other components at all."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, part, text in zip(batch["node"], batch["part_of"], batch["text"]):
                yield pd.DataFrame({"token": shingle_set(text, width).view(np.int64), "node": node, "part_of": part})

    near = tokens.select("node", "part_of").distinct()
    full = with_small(texts, near, "node").select("node", "part_of", "text").mapInPandas(explode, "token long, node long, part_of long")
    full, full_path = stage_at(full, "open-shingles")
    shared = _between_components(full, ["token"]).groupBy("node").agg(F.count(F.lit(1)).alias("shared"))
    able = tokens.select("node", "n").distinct().join(shared, "node").where(F.col("shared") * 100 >= F.col("n") * percent).select("node")
    left = stage_table(_between_components(tokens.join(able, "node", "left_semi"), ["token"]), "open-tokens")
    drop_staged(tokens.sparkSession, full_path)
    return left


def _opener(width: int, percent: int):
    def open_group(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between members, or of queries with members when there are any: one star for each component that they make."""
        rows = rows.sort_values("node")
        is_query = rows["query"].to_numpy(bool)
        sets = [shingle_set(t, width) for t in rows["text"]]
        inside = np.flatnonzero(~is_query)
        asking = np.flatnonzero(is_query) if is_query.any() else inside
        both = overlaps([sets[k] for k in asking], [sets[k] for k in inside])
        n = np.array([len(s) for s in sets])
        union = n[asking][:, None] + n[inside] - both
        linked = 100 * both >= percent * union
        node, before = rows["node"].to_numpy(np.int64), rows["part_of"].to_numpy(np.int64)
        part = before.copy()
        for k, a in enumerate(asking):
            for other in np.unique(part[inside[linked[k]]]):
                if other != part[a]:
                    part[part == other] = part[a]
        # The smallest node of each earlier component, linked to the smallest of those that it has met.
        first = np.sort(np.unique(before, return_index=True)[1])
        _, lead, of = np.unique(part[first], return_index=True, return_inverse=True)
        a, b = node[first[lead[of]]], node[first]
        return pd.DataFrame({"a": a[a != b], "b": b[a != b]})

    return open_group


def overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 1 << 13) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 matrices over slices of the tokens of ``right``."""
    out = np.zeros((len(left), len(right)), np.int64)
    known = np.unique(np.concatenate(right)) if right else np.empty(0, np.uint64)
    for start in range(0, len(known), columns):
        part = known[start : start + columns]
        matrix = [np.zeros((len(side), len(part)), np.float32) for side in (left, right)]
        for side, rows in zip((left, right), matrix):
            for k, s in enumerate(side):
                own = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
                at = np.searchsorted(part, own)
                rows[k, at[part[at] == own]] = 1
        out += np.rint(matrix[0] @ matrix[1].T).astype(np.int64)
    return out


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: of its smallest doc_id, and of that id's text with the smallest hash.

    Rows without id come last, so only a component without any id keeps one of them. Documents
    without shingles are copies of nothing and all stay.
    """
    found = stage_table(_components(docs.select("doc_id", "text"), width, percent), "components")
    counted = found.where("n_shingles > 0").groupBy("part", F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    chosen = counted.groupBy("part").agg(F.min(F.struct("none", "doc_id", "text_hash", "n")).alias("k"))
    lone = found.where("n_shingles = 0").select("doc_id", "text_hash").distinct()
    chosen = stage_table(chosen.select("k.doc_id", "k.text_hash", "k.n").unionByName(lone.withColumn("n", F.lit(1).cast("long"))), "chosen")

    def rows_of(keys: DataFrame) -> DataFrame:
        names = keys.select(F.col("doc_id").alias("_keep_id"), F.col("text_hash").alias("_keep_text"))
        return docs.join(names, F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.xxhash64("text") == F.col("_keep_text")), "left_semi")

    once, repeated = rows_of(chosen.where("n = 1")), chosen.where("n > 1")
    if not repeated.take(1):
        return once
    # Of rows with one id and text the first in order of all columns stays.
    first = rows_of(repeated).groupBy("doc_id", F.xxhash64("text").alias("_text")).agg(F.min(F.struct(*docs.columns)).alias("_first"))
    return once.unionByName(first.select("_first.*"))
