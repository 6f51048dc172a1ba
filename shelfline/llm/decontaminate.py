"""Benchmark decontamination with one Aho-Corasick automaton over the words of all items.

Items and documents are normalised alike: A-Z lowered, words are runs of letters and digits (and
any character beyond ASCII). Every window of ``window`` consecutive item words is a pattern, a
shorter item is one pattern as a whole. The automaton reads a document's words once and gives every
occurrence of every pattern; word numbers are mapped back to character offsets of the original text.

The automaton is built in each task from the item texts, which are sent to all tasks only up to
``ITEM_BYTES``. A larger benchmark is split by a hash of the item into parts below that size;
documents are scanned once a part and the spans found are united per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import set_aside
from shelfline.session import stage_table

WINDOW = 10
#: Text of benchmark items that one automaton may hold.
ITEM_BYTES = 8 << 20

#: Byte table: A-Z to a-z, letters, digits and bytes beyond ASCII as they are, all else a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class Matcher:
    """Automaton over word numbers; ``items`` are (item_id, text)."""

    def __init__(self, items: list[tuple], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple, list] = {}
        for item_id, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in item_words(text))
            if ids:
                width = min(window, len(ids))
                for k in range(len(ids) - width + 1):
                    own = owners.setdefault(ids[k : k + width], [])
                    if not own or own[-1] != item_id:
                        own.append(item_id)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, own in owners.items():
            self.automaton.add_word(ids, (len(ids), own))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Merged [start, end) spans of hit words, and the items that occur."""
        spans: list[list[int]] = []
        found: set = set()
        if self.empty or not words:
            return spans, found
        for last, (width, own) in self.automaton.iter(tuple(map(self.number.get, words, repeat(0)))):
            found.update(own)
            start = last - width + 1
            while spans and spans[-1][0] >= start:  # a longer pattern that ends here starts earlier
                spans.pop()
            if spans and start <= spans[-1][1]:
                spans[-1][1] = last + 1
            else:
                spans.append([start, last + 1])
        return spans, found


def word_offsets(text: str, spans: list[list[int]]) -> list[list[int]]:
    """Character offsets in the original text of word spans."""
    if not spans:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    flat, begins, ends, at = raw.translate(WORD_BYTES), [], [], 0
    wanted = {s for s, _ in spans} | {e - 1 for _, e in spans}
    edges = {}
    for number, word in enumerate(flat.split()):
        at = flat.index(word, at)
        if number in wanted:
            edges[number] = (at, at + len(word))
        at += len(word)
    # Bytes to characters, walking forward once.
    chars, byte = 0, 0
    for s, e in spans:
        for edge, out in ((edges[s][0], begins), (edges[e - 1][1], ends)):
            chars += len(raw[byte:edge].decode("utf-8", "surrogatepass"))
            byte = edge
            out.append(chars)
    return [list(x) for x in zip(begins, ends)]


RESULT = "n_words long, spans array<array<int>>, chars array<array<int>>, items array<string>"


def _scanner(items: DataFrame, window: int):
    rows = [(r["item_id"], r["text"]) for r in items.where("item_id IS NOT NULL").select("item_id", "text").collect()]
    sent = items.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(sent.value, window)
        for texts in batches:
            out = []
            for text in texts:
                words = item_words(text)
                spans, found = matcher.scan(words)
                out.append((len(words), spans, word_offsets(text, spans) if spans else [], [str(x) for x in found]))
            yield pd.DataFrame(out, columns=["n_words", "spans", "chars", "items"])

    return scan


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``docs`` with ``_scan``: struct of n_words, word spans, character spans and item ids as text.

    Null and empty texts have no words. Items without words or id never occur. Repeated items count
    once, repeated documents each for themselves.
    """
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= item_bytes:
        return docs.withColumn("_scan", _scanner(items, window)(F.col("text")))
    parts = 1 + 2 * size // item_bytes
    key = [F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")]
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        one = stage_table(docs.select(*key, _scanner(own, window)(F.col("text")).alias("s")).select("_id", "_hash", "s.*"), "spans")
        found = one if found is None else found.unionByName(one)
    flat = lambda name: F.flatten(F.collect_set(name)).alias(name)
    united = found.groupBy("_id", "_hash").agg(F.max("n_words").alias("n_words"), flat("spans"), flat("chars"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    united = united.select("_id", "_hash", F.struct("n_words", _merge("spans").alias("spans"), _merge("chars").alias("chars"), "items").alias("_scan"))
    joined = docs.join(united, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
    return joined.drop("_id", "_hash")


def _merge(spans: str):
    """Sorted spans with those that touch or overlap united."""
    none = F.array().cast("array<array<int>>")

    def step(done, span):
        last = F.element_at(done, -1)
        head = F.slice(done, 1, F.size(done) - 1)
        joined = F.concat(head, F.array(F.array(last[0], F.greatest(last[1], span[1]))))
        return F.when((F.size(done) > 0) & (F.try_element_at(F.try_element_at(done, F.lit(-1)), F.lit(2)) >= span[0]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.sort_array(spans), none, step)


def hit_words() -> Column:
    """Number of words of ``_scan`` that lie in a span."""
    return F.aggregate("_scan.spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) for every row of (doc_id, text)."""
    scanned = scan(docs.select("doc_id", "text"), items, window, item_bytes)
    hit = hit_words()
    return scanned.select(
        "doc_id", F.col("_scan.n_words").alias("n_words"), hit.alias("n_hit"), F.size("_scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("_scan.items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), F.col("_scan.chars").alias("spans"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns, whatever their names."""
    docs, back = set_aside(docs, "_scan", "_id", "_hash", "s")
    return scan(docs, items, window).where(F.size("_scan.spans") == 0).drop("_scan").withColumnsRenamed(back)
