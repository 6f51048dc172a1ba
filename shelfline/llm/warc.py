"""WARC archives: written with the text writer, read back by boundary-chain verification.

Writing. Pages are records; of equal payloads one is a response and the others revisit it. Texts are
written with the record end (two line breaks) as line separator, so a part file is a WARC file.

Reading. Every occurrence of the version line may start a record, or may stand inside a payload.
Files are split at it by Spark's text reader, so any number of tasks reads one file. Each piece gives
its offset (running sums of piece lengths, first in a split, then over splits) and the offset of its
successor by its Content-Length. Only pieces that the chain of successors reaches from the start of
the file are records. Pieces that link to the piece behind them form runs, in one pass over a file; reachability
of runs is found by pointer jumping, which doubles the length of known chains in each round. A header may hold the mark too, so it goes on
over the following pieces up to the first that has its end. Pieces in between belong to the header or
payload of the record before them and are put together again; their bytes are read a second time and found by their
SHA-256, since how Spark cuts files into splits may differ between two reads. Only offsets and
lengths take part in the rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.common import drop_staged, scratch_path, stage_at
from shelfline.session import stage_table

VERSION = "WARC/1.1\r\n"
#: What every record starts with, whatever its minor version.
MARK = "WARC/1."
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
MIN_PAYLOAD = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` from (page_id, url, html).

    refers_to is the smallest page_id with the same payload, for payloads of ``min_payload`` bytes or
    more in other pages; rows that share the smallest page_id are all responses. A null page_id is
    never the smallest unless all are null, and then all are responses. Only digests are shuffled
    to find equals; texts are joined to the digests that occur twice, a table that Spark sends to
    all tasks when it is small.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    digest = F.sha2("payload", 256)
    large = rows.where(F.octet_length("payload") >= min_payload).select(digest.alias("same"), "page_id")
    twice = large.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = stage_table(twice.select("same", "first"), "payloads")
    joined = rows.withColumn("digest", digest).join(twice, (F.col("digest") == F.col("same")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _header(name: str, value: Column) -> Column:
    """One header line; absent when the value is null. Line breaks cannot be in a header and are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(name + ": "), safe, F.lit("\r\n")), F.lit(""))


def record(page_id: Column, url: Column, payload: Column, digest: Column, refers_to: Column) -> Column:
    """Text of one record without its end."""
    revisit = refers_to.isNotNull()
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit(END),
        F.when(revisit, F.lit("")).otherwise(payload),
    )
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _header("WARC-Record-ID", page(page_id)), F.lit(f"WARC-Date: {DATE}\r\n"), _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _header("WARC-Refers-To", F.when(revisit, page(refers_to))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )


def write_archives(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, records_per_file: int = 50_000) -> None:
    """Write (page_id, url, html) as WARC files below ``path``; a task starts a new file after ``records_per_file``."""
    rows = with_revisits(pages, min_payload)
    text = rows.select(record(F.col("page_id"), F.col("url"), F.col("payload"), F.col("digest"), F.col("refers_to")).alias("value"))
    text.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, body): what stands behind each occurrence of the mark, and where that line starts."""
    read = spark.read.option("lineSep", MARK).text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
        F.col("value").cast("binary").alias("body"),
    )


def _content(body: Column) -> Column:
    """What stands for the bytes of a piece."""
    return F.unhex(F.sha2(body, 256))


HEADERS = ["WARC-Type", "WARC-Record-ID", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Refers-To"]


def _parsed(pieces: DataFrame) -> DataFrame:
    """Facts of each piece as if it were a record; ``need`` is the number of bytes its record has behind the mark.

    ``need`` is null when the header does not end in the piece (``ended``); see :func:`_linked`.
    """
    text = F.col("body").cast("string")
    head = F.substring_index(text, END, 1)
    head_bytes = F.octet_length(head)
    ended = F.contains(text, F.lit(END))
    length = F.regexp_extract(head, r"(?i)\nContent-Length: *([0-9]{1,18})", 1)
    length = F.when(length != "", length.cast("long"))
    # Offsets of the block's own parts, in bytes.
    block = F.substring(F.col("body"), head_bytes + 1 + len(END), 2_000_000_000)
    http = F.substring_index(block.cast("string"), END, 1)
    skip = F.when(F.startswith(block.cast("string"), F.lit("HTTP/")), F.octet_length(http) + len(END)).otherwise(0)
    return pieces.select(
        "*", F.octet_length("body").alias("size"), F.when(ended, head_bytes + 2 * len(END) + length).alias("need"), (head_bytes + len(END) + skip).alias("at"),
        ended.alias("ended"), head_bytes.alias("head_bytes"), length.alias("length"),
        *[F.regexp_extract(head, rf"(?i)\n{h}: *([^\r\n]*)", 1).alias(h) for h in HEADERS],
    )


def _offsets(facts: DataFrame) -> DataFrame:
    """Adds ``offset``: the byte where the piece's mark starts in its file.

    The text before the first mark of a file, normally nothing, is piece 0 with offset -len(MARK).
    """
    each = F.col("size") + len(MARK)
    # Rows of one split are few thousand numbers; splits of one file are fewer still.
    run = F.sum(each).over(Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)) - each
    splits = facts.groupBy("file", "block").agg(F.sum(each).alias("whole"))
    before = F.sum("whole").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("whole")
    splits = splits.select("file", "block", before.alias("before"))
    return facts.withColumn("within", run).join(splits, ["file", "block"]).withColumn("offset", F.col("before") + F.col("within") - len(MARK)).drop("before", "within")


def _linked(placed: DataFrame) -> DataFrame:
    """Adds ``next``: where the record of each piece ends, by the header up to the first end at or behind the piece."""
    onwards = Window.partitionBy("file").orderBy(F.col("offset").desc()).rowsBetween(Window.unboundedPreceding, 0)
    end = F.last(F.when(F.col("ended"), F.col("offset") + len(MARK) + F.col("head_bytes")), ignorenulls=True).over(onwards)
    # The first length in the header; a piece with the header's end and no length ends the search.
    length = F.last(F.when(F.col("ended") | F.col("length").isNotNull(), F.struct("length")), ignorenulls=True).over(onwards)["length"]
    return placed.withColumn("next", end + 2 * len(END) + length)


def _runs(links: DataFrame) -> DataFrame:
    """Adds ``run`` to (file, offset, next): pieces that each link to the piece behind them are one run; ``leaves`` is set on a last piece that links elsewhere."""
    order = Window.partitionBy("file").orderBy("offset")
    joined = F.coalesce(F.lag("next").over(order) == F.col("offset"), F.lit(False))
    leaves = (F.col("next") > F.col("offset")) & ~F.coalesce(F.lead("offset").over(order) == F.col("next"), F.lit(False))
    # The chain only leads onwards from offset 0.
    marked = links.where("offset >= 0").select("file", "offset", "next", F.when(joined, 0).otherwise(1).alias("new"), F.coalesce(leaves, F.lit(False)).alias("leaves"))
    return marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) of the pieces that the chain from offset 0 reaches, by pointer jumping over the runs of (file, offset, next).

    A run is left only at its end, so where the chain enters it says which of its pieces are reached. Records
    without the mark inside are one run a file; rounds double the number of runs within reach.
    """
    spark = links.sparkSession
    runs = stage_table(_runs(links), "runs")
    seen = runs.where("offset = 0").select("file", "run", F.col("offset").alias("enter"))
    enter = runs.select("file", F.col("offset").alias("next"), F.col("run").alias("to"))
    jump, jump_path = stage_at(runs.where("leaves").select("file", "run", "next").join(enter, ["file", "next"]).select("file", "run", "to", F.col("next").alias("enter")), "jumps")
    seen_path, count = None, seen.count() if jump.take(1) else 0
    # Chains of 1, 2, 4, ... runs: everything within reach doubles in each round.
    while count:
        ahead = seen.drop("enter").join(jump, ["file", "run"]).select("file", F.col("to").alias("run"), "enter")
        more, more_path = stage_at(seen.unionByName(ahead).distinct(), "seen")
        if seen_path:
            drop_staged(spark, seen_path)
        seen, seen_path, now = more, more_path, more.count()
        if now == count:  # no chain is longer than the jumps so far
            break
        count = now
        same = (F.col("j.file") == F.col("n.file")) & (F.col("j.to") == F.col("n.run"))
        twice = jump.alias("j").join(jump.alias("n"), same)
        twice, twice_path = stage_at(twice.select("j.file", "j.run", "n.to", "n.enter"), "jumps")
        drop_staged(spark, jump_path)
        jump, jump_path = twice, twice_path
    drop_staged(spark, jump_path)
    return runs.join(seen, ["file", "run"]).where("offset >= enter").select("file", "offset")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files below ``path``: file, offset, record_type, record_id, url, header_digest, refers_to, payload_bytes, payload_digest, complete and payload.

    ``complete`` says whether the file holds as many bytes as the record's header asks for. Without
    ``payloads`` no payload is kept behind the first pass over the files, except of the records that
    have the mark in their header or payload.
    """
    facts = _parsed(_pieces(spark, path))
    payload = F.substring(F.col("body"), F.col("at") + 1, (F.col("need") - len(END) - F.col("at")).cast("int"))
    complete = F.col("size") >= F.col("need") - len(END)
    whole = facts.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": F.sha2(payload, 256), "complete": complete})
    whole = whole.withColumn("content", _content(F.col("body")))
    whole = whole.withColumn("payload", payload) if payloads else whole
    kept = ["payload"] if payloads else []
    table = stage_table(whole.drop("body"), "pieces")
    placed = _linked(_offsets(table.select("file", "block", "place", "size", "ended", "head_bytes", "length")))
    placed = stage_table(placed.select("file", "block", "place", "offset", "next"), "offsets")
    seen = reachable(placed.select("file", "offset", "next"))
    found = placed.join(seen.withColumn("start", F.lit(True)), ["file", "offset"], "left")
    # The record that a piece lies in: the last start at or before it, when that record reaches so far.
    last = F.max(F.when(F.col("start"), F.struct("offset", "next"))).over(Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0))
    found = found.withColumn("_last", last).where("start OR offset < _last.next")
    found = stage_table(found.withColumn("owner", F.col("_last.offset")).drop("_last"), "owners")
    records = table.join(found.where("start").select("file", "block", "place", "offset"), ["file", "block", "place"])
    inner = found.where("start IS NULL").select("file", "owner").distinct()
    if inner.take(1):
        pieces = found.join(inner, ["file", "owner"], "left_semi").join(table.select("file", "block", "place", "content"), ["file", "block", "place"])
        mended = _mended(spark, path, stage_table(pieces.select("file", "owner", "offset", "content"), "torn"))
        new = [c for c in mended.columns if c not in ("file", "offset")]
        records = records.join(mended.select("file", "offset", F.lit(True).alias("_mended"), *[F.col(f"`{c}`").alias(f"_{c}") for c in new]), ["file", "offset"], "left")
        records = records.withColumns({c: F.when(F.col("_mended"), F.col(f"`_{c}`")).otherwise(F.col(f"`{c}`")) for c in new if c in records.columns})
    plain = lambda h: F.nullif(F.col(f"`{h}`"), F.lit(""))
    return records.select(
        "file", "offset", F.col("`WARC-Type`").alias("record_type"), plain("WARC-Record-ID").alias("record_id"), plain("WARC-Target-URI").alias("url"),
        F.regexp_replace(plain("WARC-Payload-Digest"), "^sha256:", "").alias("header_digest"), plain("WARC-Refers-To").alias("refers_to"),
        "payload_bytes", "payload_digest", "complete", *kept,
    )


def _mended(spark: SparkSession, path: str, pieces: DataFrame) -> DataFrame:
    """Facts of the records whose header or payload holds the mark: their pieces (file, owner, offset, content) are read again and joined.

    Pieces of equal content are equal bytes, so nothing depends on where this read finds them.
    """
    wanted = pieces.select("content").distinct()
    bodies = _pieces(spark, path).select("body", _content(F.col("body")).alias("content")).join(wanted, "content", "left_semi")
    bodies = bodies.groupBy("content").agg(F.first("body").alias("body"))
    # A piece that is not found again stays null and fails the record's completeness.
    joined = pieces.join(bodies, "content", "left").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "body"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["body"].cast("string")), MARK)
    facts = _parsed(joined.select("file", F.col("owner").alias("offset"), text.cast("binary").alias("body")))
    payload = F.substring(F.col("body"), F.col("at") + 1, (F.col("need") - len(END) - F.col("at")).cast("int"))
    return facts.select(
        "file", "offset", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
        (F.col("size") >= F.col("need") - len(END)).alias("complete"), payload.alias("payload"), *[F.col(f"`{h}`") for h in HEADERS],
    )


def page_of(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")


def round_trip(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of (page_id, url, html) written and read back.

    A revisit has no payload of its own; both figures are those of the response that it refers to,
    taken from that record's bytes. Null html is an empty payload. A record that comes back cut is an error.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_payload)
    records = read_archives(spark, path, payloads=False)
    records = stage_table(records.select(page_of(F.col("record_id")).alias("page_id"), "record_type", page_of(F.col("refers_to")).alias("refers_to"), "payload_bytes", "payload_digest", "header_digest", "complete"), "records")
    drop_staged(spark, path)
    cut = records.where("NOT coalesce(complete, false)").count()
    if cut:
        raise RuntimeError(f"{cut} records were not read back whole")
    own = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    # Responses of one page_id may be several; the payload is the one whose digest the revisit names.
    first = own.select(F.col("page_id").alias("to"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b")).distinct()
    again = records.where("record_type = 'revisit'").select("page_id", "refers_to", "header_digest").join(first, (F.col("refers_to") == F.col("to")) & (F.col("header_digest") == F.col("d")))
    return own.unionByName(again.select("page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to"))
