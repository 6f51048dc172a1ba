"""Reversible line dedup: exact reference counts in tables, sharded cuckoo filters in front of them.

An index has three tables in the shared folder.

* ``postings``: each (line key, doc_id) once; the ground truth that makes deletion exact.
* ``counts``: shard, key, number of documents and largest doc_id of each key.
* ``filters``: one cuckoo filter a shard with the keys that reach ``min_docs``.

``insert`` adds documents, ``delete`` takes them back; both touch only the counts of keys that occur
in the batch and add or remove fingerprints where a key crosses ``min_docs``. ``dedup`` probes the
filters to find the few lines that may be repeated and confirms these in ``counts``, so that lines
that occur once are never shuffled. A filter errs on one side only, hence results are exact.

Skew: a line in a third of all documents is one row of ``counts`` after map-side aggregation, and
its occurrences meet that row in a join whose large partitions Spark splits. No list of a key's
documents is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import cuckoo
from shelfline.llm.common import BLANKS, lower_ascii, set_aside
from shelfline.session import stage_table

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys a shard should hold, so that one task builds its filter in little memory.
KEYS_PER_SHARD = 200_000
#: Filters are sent to all tasks up to this size (half a byte over two bytes a repeated key); beyond it lines meet the counts without them.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


def lines_of(text: Column) -> Column:
    """Lines between line feeds; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _long_lines(text: Column, min_chars: int) -> Column:
    """Array of (pos, key) of the lines whose key is long enough; a key is the md5 of its text."""
    keyed = F.transform(lines_of(text), lambda line, pos: F.struct(pos.alias("pos"), line_key(line).alias("key")))
    kept = F.filter(keyed, lambda k: F.length(k["key"]) >= min_chars)
    return F.transform(kept, lambda k: F.struct(k["pos"].alias("pos"), F.unhex(F.md5(k["key"])).alias("key")))


def _postings(docs: DataFrame, min_chars: int) -> DataFrame:
    keys = F.array_distinct(F.transform(_long_lines(F.col("text"), min_chars), lambda k: k["key"]))
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(keys).alias("key")).distinct()


def _counted(postings: DataFrame, shards: int) -> DataFrame:
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")
    grouped = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("top_doc"))
    return grouped.select(shard, "key", "n_docs", "top_doc")


def create(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> LineIndex:
    """Index of ``docs`` (doc_id, text). Rows of one doc_id are one document; a null id is in no document."""
    postings = stage_table(_postings(docs, min_chars), "line-postings")
    shards = 1 + postings.count() // KEYS_PER_SHARD
    counts = stage_table(_counted(postings, shards), "line-counts")
    return LineIndex(postings, counts, _build_filters(counts, min_docs), shards, min_docs, min_chars)


FILTER_SCHEMA = "shard int, blob binary"


def _build_filters(counts: DataFrame, min_docs: int) -> DataFrame:
    def one_shard(keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": keys["shard"].iloc[:1].astype("int32"), "blob": [cuckoo.pack(cuckoo.build(keys["h"].to_numpy()))]})

    repeated = counts.where(F.col("n_docs") >= min_docs).select("shard", F.xxhash64("key").alias("h"))
    return stage_table(repeated.groupBy("shard").applyInPandas(one_shard, FILTER_SCHEMA), "line-filters")


def insert(index: LineIndex, docs: DataFrame) -> LineIndex:
    """Index with ``docs`` added. Inserting a document twice changes nothing."""
    fresh = _postings(docs, index.min_chars).join(index.postings, ["key", "doc_id"], "left_anti")
    fresh = stage_table(fresh, "line-batch")
    return _changed(index, index.postings.unionByName(fresh), fresh)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """Index without the documents in ``doc_ids`` (doc_id): as if they had never been inserted."""
    gone = stage_table(index.postings.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi"), "line-batch")
    left = index.postings.join(gone, ["key", "doc_id"], "left_anti")
    return _changed(index, left, gone)


def _changed(index: LineIndex, postings: DataFrame, batch: DataFrame) -> LineIndex:
    """Recount the keys of ``batch`` from their postings and move their fingerprints."""
    postings = stage_table(postings, "line-postings")
    touched = batch.select("key").distinct()
    after = _counted(postings.join(touched, "key", "left_semi"), index.shards)
    counts = stage_table(index.counts.join(touched, "key", "left_anti").unionByName(after), "line-counts")
    was = index.counts.join(touched, "key", "left_semi").select("key", F.col("n_docs").alias("was"))
    now = counts.join(touched, "key", "left_semi").select("key", F.col("n_docs").alias("now"))
    both = was.join(now, "key", "full").na.fill(0, ["was", "now"])
    up, down = F.col("now") >= index.min_docs, F.col("was") >= index.min_docs
    crossed = both.where(up != down).select(
        F.pmod(F.xxhash64("key"), F.lit(index.shards)).cast("int").alias("shard"), F.xxhash64("key").alias("h"), up.alias("up")
    )
    filters = stage_table(_move(index.filters, crossed), "line-filters")
    # A shard that ran full comes back without a filter and is built anew from the exact counts.
    full = filters.where("blob IS NULL").select("shard")
    rebuilt = _build_filters(counts.join(full, "shard", "left_semi"), index.min_docs)
    filters = filters.where("blob IS NOT NULL").unionByName(rebuilt)
    return LineIndex(postings, counts, filters, index.shards, index.min_docs, index.min_chars)


def _move(filters: DataFrame, crossed: DataFrame) -> DataFrame:
    def one_shard(old: pd.DataFrame, moves: pd.DataFrame) -> pd.DataFrame:
        shard = (old if len(old) else moves)["shard"].iloc[:1].astype("int32")
        come, go = moves.loc[moves["up"].astype(bool), "h"].to_numpy(), moves.loc[~moves["up"].astype(bool), "h"].to_numpy()
        if not len(old):
            return pd.DataFrame({"shard": shard, "blob": [cuckoo.pack(cuckoo.build(come))]})
        table = cuckoo.unpack(old["blob"].iloc[0])
        cuckoo.delete(table, go)
        room = np.count_nonzero(table) + len(come) <= cuckoo.FULL * table.size
        return pd.DataFrame({"shard": shard, "blob": [cuckoo.pack(table) if room and cuckoo.insert(table, come) else None]})

    return filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(one_shard, FILTER_SCHEMA)


def _probe(index: LineIndex):
    """Column function that keeps the hashes which a filter may hold, or None when the filters are too large to send."""
    size = index.filters.agg(F.sum(F.length("blob"))).first()[0] or 0
    if size > BROADCAST_BYTES:
        return None
    shards = index.shards
    sent = index.filters.sparkSession.sparkContext.broadcast([(r["shard"], bytes(r["blob"])) for r in index.filters.collect()])

    @F.pandas_udf("array<int>")
    def maybe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = {shard: cuckoo.unpack(blob) for shard, blob in sent.value}
        for batch in batches:
            sizes = [len(x) for x in batch]
            flat = np.concatenate([np.asarray(x, np.int64) for x in batch]) if sum(sizes) else np.empty(0, np.int64)
            hit, of = np.zeros(len(flat), bool), np.mod(flat, shards)
            for shard, table in tables.items():
                own = np.flatnonzero(of == shard)
                hit[own] = cuckoo.contains(table, flat[own])
            yield pd.Series([np.flatnonzero(x).astype(np.int32) for x in np.split(hit, np.cumsum(sizes)[:-1])], index=batch.index)

    return maybe


def repeated_lines(index: LineIndex, docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, drop): sorted positions of the lines that ``docs`` lose. Documents that lose none are absent."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _long_lines(F.col("text"), index.min_chars).alias("keys"))
    probe = _probe(index)
    if probe is None:
        lines = keyed.select("doc_id", "text_hash", F.explode("keys").alias("line"))
    else:
        hits = keyed.select("doc_id", "text_hash", "keys", probe(F.transform("keys", lambda k: F.xxhash64(k["key"]))).alias("hits"))
        lines = hits.select("doc_id", "text_hash", F.explode(F.transform("hits", lambda i: F.get("keys", i))).alias("line"))
    repeated = index.counts.where(F.col("n_docs") >= index.min_docs).select("key", "top_doc")
    found = lines.select("doc_id", "text_hash", "line.pos", "line.key").join(repeated, "key").where("NOT (doc_id <=> top_doc)")
    return found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drop"))


def dedup(index: LineIndex, docs: DataFrame, text: str = "kept_text") -> DataFrame:
    """``docs`` with n_lines, n_dropped and ``text``: the lines that stay, joined by line feeds.

    A repeated line stays in the largest doc_id that holds it, in each of its rows and at each of
    its positions there. Null and empty texts have one empty line, which always stays. Rows
    without an id lose repeated lines and count towards none. Other columns are left alone, whatever their
    names; only columns of the three names above are replaced.
    """
    docs, back = set_aside(docs, "_drop_id", "_drop_text", "_drop", "_all")
    drops = repeated_lines(index, docs).select(F.col("doc_id").alias("_drop_id"), F.col("text_hash").alias("_drop_text"), F.col("drop").alias("_drop"))
    joined = docs.join(drops, F.col("doc_id").eqNullSafe(F.col("_drop_id")) & (F.xxhash64("text") == F.col("_drop_text")), "left")
    lines = lines_of(F.col("text"))
    # The pieces between dropped positions, cut out of the array of lines: linear in the number of lines.
    start = lambda j: F.when(j == 0, 0).otherwise(F.get("_drop", j - 1) + 1)
    end = lambda j: F.when(j == F.size("_drop"), F.size("_all")).otherwise(F.get("_drop", j))
    pieces = F.transform(F.sequence(F.lit(0), F.size("_drop")), lambda j: F.slice("_all", start(j) + 1, end(j) - start(j)))
    kept = F.when(F.col("_drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.flatten(pieces), "\n"))
    dropped = F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop"))
    return (
        joined.withColumn("_all", lines)
        .withColumns({"n_lines": F.size("_all").cast("long"), "n_dropped": dropped.cast("long"), text: kept})
        .drop("_drop_id", "_drop_text", "_drop", "_all")
        .withColumnsRenamed(back)
    )


def without_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay in ``text``, and ``n_chars`` following it; the columns are those of ``docs``, whatever their names.

    A document that loses nothing keeps its text as it is, null included.
    """
    rows, back = set_aside(docs, "n_lines", "n_dropped", "_kept")
    kept, changed = dedup(create(rows), rows, "_kept"), F.col("n_dropped") > 0
    length = F.length("_kept").cast(rows.schema["n_chars"].dataType)
    values = {"text": F.when(changed, F.col("_kept")).otherwise(F.col("text")), "n_chars": F.when(changed, length).otherwise(F.col("n_chars"))}
    return kept.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns]).withColumnsRenamed(back)
