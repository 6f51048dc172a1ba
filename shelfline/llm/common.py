"""Text helpers and staged tables shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import drop_staged, scratch_path, stage_at, stage_table  # noqa: F401

#: The white space of every contract here: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; every other letter as it is."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").select(*columns)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``; a null id has no remainder."""
    return F.crc32(F.col(key).cast("string")) % modulus


def raw_words(text: str | None) -> list[bytes]:
    """Words between blanks, A-Z lowered. ``bytes.split`` and ``bytes.lower`` know ASCII only, as asked."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def set_aside(df: DataFrame, *helpers: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns of the helpers' names under other names, and the mapping that gives them back."""
    taken, moved = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower() in {h.lower() for h in helpers}:
            name = f"{c}_own"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            moved[c] = name
    return df.withColumnsRenamed(moved), {name: c for c, name in moved.items()}


#: Rows of a few numbers that may be sent to all tasks instead of shuffling texts to them.
BROADCAST_ROWS = 2_000_000


def with_small(rows: DataFrame, small: DataFrame, on: str, how: str = "inner", bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``rows``, which carry texts, with a narrow table: broadcast when it is counted to be small, else shuffled."""
    small = stage_table(small, "narrow")
    return rows.join(F.broadcast(small) if small.count() <= bound else small, on, how)
