"""Exact token counts of huge documents from overlapping chunks.

A document up to ``CHUNK`` characters is encoded as a whole. A longer one is cut into chunks that
overlap; chunks are rows of their own, spread over all tasks, so a huge document is never one task's
work. Two neighbouring chunks are spliced at a *stable common boundary*: a place in their overlap

* where a blank follows another character. The vocabulary is read once to prove that none of its
  pieces spans such a place; merges on both sides are then independent of each other, so the whole
  text's encoding has a token boundary there and so has each chunk's, and
* where both chunks' own encodings do have a boundary, which is checked by their offsets.

When an overlap holds no such place, alignment fails and the overlap is widened, twice as wide each
time, up to the whole document. Nothing is estimated.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.session import stage_table

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 16
OVERLAP = 512
LIMIT = 4096
BLANK = "▁"  # what the vocabulary writes for a space


def model_bytes(name: str = MODEL) -> bytes:
    """Content of a public vocabulary file (about half a megabyte), which is sent with the job."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def proves_boundaries(processor) -> bool:
    """Whether no piece has a blank behind another character, and the text is encoded as it is."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    plain = all(BLANK not in piece.lstrip(BLANK) for piece in pieces)
    # Neither normalisation nor dropped blanks: a probe of odd characters comes back unchanged.
    probe = "a  b\tc\né é ﬁ 　x "
    return plain and processor.normalize(probe).lstrip(BLANK).replace(BLANK, " ") == probe


def boundary(text: str, start: int, end: int) -> int | None:
    """A place of ``text`` in [start, end) where a space follows another character: the one nearest the middle from there on, else the first."""
    middle = (start + end) // 2
    for a, b in ((middle, end), (start, middle)):
        at = text.find(" ", max(a, 1), b)
        while at >= 0 and text[at - 1] in (" ", BLANK):
            at = text.find(" ", at + 1, b)
        if at >= 0:
            return at
    return None


def chunks_of(text: str, size: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(start, end, from, to): chunk [start, end) of ``text`` counts tokens in [from, to).

    Consecutive chunks share ``overlap`` characters or more; from and to are the splices.
    """
    out, start, splice, total = [], 0, 0, len(text)
    while True:
        end, wide, cut = start + size, overlap, None
        while end < total:
            cut = boundary(text, max(start + 1, end - wide, splice + 1), end)
            if cut is not None:
                break
            # Widen: both chunks reach further, until there is a place or the text ends.
            wide *= 2
            end = min(total, end + wide)
        if end >= total:
            out.append((start, total, splice, total))
            return out
        out.append((start, end, splice, cut))
        # The next chunk begins as far before the splice as this one reaches behind it, at least.
        start, splice = max(0, cut - overlap // 2), cut


def count_between(processor, text: str, start: int, end: int, first: int, last: int) -> int | None:
    """Tokens of chunk [start, end) that lie in [first, last); None when one of them is no boundary of its encoding."""
    if start == first and end == last:
        return len(processor.encode(text[start:end]))
    part = text[start:end]
    pieces = processor.encode(part, return_type="proto").pieces
    # The library counts offsets in bytes of UTF-8.
    low, high, whole = (len(part[: k - start].encode("utf-8", "surrogatepass")) for k in (first, last, end))
    begins = [p.begin for p in pieces]
    edges = set(begins) | {whole}
    if low not in edges or high not in edges:
        return None
    # Byte pieces of one character share its offset; no character crosses an edge.
    return sum(low <= b < high for b in begins)


def counts(docs: DataFrame, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of (doc_id, text). Null and empty texts have 0 tokens.

    Short texts are counted where they are read. Chunks of long texts are written once and counted
    in their own tasks. Rows of one doc_id and text are counted alike, each for itself.
    """
    docs = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("long")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        processor = load(sent.value)
        for texts in batches:
            yield pd.Series([len(processor.encode(t)) if t else 0 for t in texts], dtype="int64")

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    short = docs.where(~is_long).select("doc_id", n_bytes, whole("text").alias("n_tokens"))
    return short.unionByName(_long_counts(docs.where(is_long), n_bytes, sent, chunk, overlap))


def _long_counts(docs: DataFrame, n_bytes, sent, chunk: int, overlap: int) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        proven = proves_boundaries(load(sent.value))
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"]):
                parts = chunks_of(text, chunk, overlap) if proven else [(0, len(text), 0, len(text))]
                for start, end, first, last in parts:
                    yield pd.DataFrame([(key, start, text[start:end], first - start, last - start)], columns=["key", "start", "piece", "first", "last"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        processor = load(sent.value)
        for batch in batches:
            n = [count_between(processor, p, 0, len(p), f, t) for p, f, t in zip(batch["piece"], batch["first"], batch["last"])]
            yield pd.DataFrame({"key": batch["key"], "n": pd.array(n, dtype="Int64")})

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        processor = load(sent.value)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "n": [len(processor.encode(t)) for t in batch["text"]]})

    key = F.sha2("text", 256).alias("key")
    keyed = stage_table(docs.select("doc_id", key, n_bytes), "long-documents")
    texts = docs.select(key, "text")
    pieces = texts.mapInPandas(cut, "key string, start long, piece string, first int, last int").distinct()
    # distinct() also deals the chunks out by their content: repeated long texts are encoded once.
    counted = stage_table(pieces.mapInPandas(count, "key string, n long"), "chunk-counts")
    sums = counted.groupBy("key").agg(F.sum("n").alias("n"), F.bool_or(F.col("n").isNull()).alias("failed"))
    # An encoding that has no boundary at a splice, against the proof: the document is widened to one chunk.
    failed = counted.where("n IS NULL").select("key").distinct()
    widened = texts.join(failed, "key", "left_semi").dropDuplicates(["key"]).mapInPandas(again, "key string, n long")
    total = sums.where("NOT failed").select("key", "n").unionByName(widened)
    return keyed.join(total, "key").select("doc_id", "n_bytes", F.col("n").alias("n_tokens"))


def report(docs: DataFrame, model: bytes, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``counts`` with ``over_limit``: more than ``limit`` tokens."""
    return counts(docs, model, chunk, overlap).withColumn("over_limit", F.col("n_tokens") > limit)
