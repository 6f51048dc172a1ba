"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

A profile is the list of a language's most frequent letter n-grams (1 to 3, words marked at both
ends) over all its training texts. A document's own list is compared with each profile: every
n-gram adds the number of places it is out of place, or the length of the list when it is missing.
The language with the smallest sum wins; ties go to the first name.

Counting is done in numpy per batch and summed by (language, n-gram) in Spark; the top of each
language is found with a ranked window that Spark cuts before the shuffle. Only profiles travel:
``PLACES`` n-grams a language.
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

PLACES = 400
#: Profiles of so many languages are sent to the tasks at a time (8 bytes an n-gram); more go group by group.
MOST_LANGUAGES = 5_000
UNKNOWN = "und"
BITS = 21


def fold_table() -> np.ndarray:
    """Code point to the lower-case letter's code point; 0 for all that is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for low, high in ((0, 0x32400), (0xE0000, 0xE0200)):
        for code in range(low, high):
            char = chr(code)
            if char.isalpha():
                small = char.lower()
                table[code] = ord(small[0])
    return table


def grams(text: str, fold: np.ndarray) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams of the words of ``text``, 21 bits a letter, 0 as the mark between words."""
    letters = fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not letters.any():
        return np.empty(0, np.int64)
    s = np.zeros(len(letters) + 2, np.int64)
    s[1:-1] = letters
    s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
    two = (s[:-1] << BITS) | s[1:]
    three = (two[:-1] << BITS) | s[2:]
    # The size of an n-gram is told apart by an offset in the sign and top bits of shorter codes.
    return np.concatenate((s[s != 0], two | np.int64(-(1 << 63)), three))


def ranked(codes: np.ndarray, places: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    values, n = np.unique(codes, return_counts=True)
    return values[np.argsort(-n, kind="stable")[:places]]


#: (language, n-grams in rank order), a list; or the staged table of them when they are too many for one.
Profiles = list[tuple[str, list[int]]] | DataFrame


def profiles(docs: DataFrame, places: int = PLACES) -> Profiles:
    """Profiles from rows of (text, lang); rows with null in either teach nothing."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold = fold_table()
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                done: list = []
                held = 0
                for text in texts:
                    done.append(grams(text, fold))
                    held += len(done[-1])
                    if held > 4_000_000:
                        yield _counted(lang, done)
                        done, held = [], 0
                if held:
                    yield _counted(lang, done)

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInPandas(count, "lang string, gram long, n long")
    sums = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = sums.withColumn("place", place).where(F.col("place") <= places)
    lists = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("list"))
    table = stage_table(lists.select("lang", F.col("list.gram").alias("grams")), "language-profiles")
    return table if table.count() > MOST_LANGUAGES else _listed(table)


def _listed(table: DataFrame) -> list[tuple[str, list[int]]]:
    return sorted((r["lang"], r["grams"]) for r in table.collect())


def _counted(lang: str, parts: list[np.ndarray]) -> pd.DataFrame:
    values, n = np.unique(np.concatenate(parts), return_counts=True)
    return pd.DataFrame({"lang": lang, "gram": values, "n": n})


class Judge:
    """Out-of-place distances to all profiles at once: a table of places by n-gram and language."""

    def __init__(self, learned: list[tuple[str, list[int]]], places: int):
        self.names, self.places = [name for name, _ in learned], places
        self.known = np.unique(np.array([g for _, row in learned for g in row], np.int64))
        self.place = np.full((len(self.known), len(learned)), -1, np.int32)
        for column, (_, row) in enumerate(learned):
            self.place[np.searchsorted(self.known, np.array(row, np.int64)), column] = np.arange(len(row))

    def __call__(self, codes: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not self.names or not len(self.known):
            return UNKNOWN, 0.0
        own = ranked(codes, self.places)
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        theirs = self.place[at]
        away = np.abs(theirs - np.arange(len(own), dtype=np.int32)[:, None])
        away[(theirs < 0) | (self.known[at] != own)[:, None]] = self.places
        total = away.sum(axis=0)
        best = int(total.argmin())
        return self.names[best], float(1 - total[best] / (len(own) * self.places))


def predict(docs: DataFrame, learned: Profiles, places: int = PLACES) -> DataFrame:
    """``docs`` with ``_lang``: struct (lang_pred, score). Texts that are null or without a letter are ``und``, score 0.

    Whole texts are ranked, however long. Nothing but the text is read; a column ``_lang`` of the input is replaced.
    """
    if isinstance(learned, list):
        return docs.withColumn("_lang", _judged(docs.sparkSession, learned, places))
    spark, groups = docs.sparkSession, math.ceil(learned.count() / MOST_LANGUAGES)
    # Hash groups are uneven: twice as many keep each of them below the bound.
    numbered = learned.withColumn("group", F.pmod(F.xxhash64("lang"), F.lit(2 * groups)))
    judged = [_judged(spark, _listed(numbered.where(F.col("group") == g)), places) for g in range(2 * groups)]
    # A score is a distance over a length that all groups share; a group without a say answers "und" with 0.
    ranked_ = F.array_sort(F.array(*[F.struct((-j["score"]).alias("away"), (j["lang_pred"] == UNKNOWN).alias("none"), j["lang_pred"].alias("lang")) for j in judged]))
    best = ranked_[0]
    return docs.withColumn("_lang", F.struct(best["lang"].alias("lang_pred"), F.abs(best["away"]).alias("score")))


def _judged(spark, learned: list[tuple[str, list[int]]], places: int):
    sent = spark.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fold, decide = fold_table(), Judge(sent.value, places)
        for texts in batches:
            out = [decide(grams(t, fold)) if t else (UNKNOWN, 0.0) for t in texts]
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return judge("text")
