"""Toxicity of deobfuscated text.

1. A character trigram model is counted over all documents.
2. Each text is restored: words with or of leetspeak, drawn-out letters or spaced-out letters become a
   lattice of what their characters may stand for, and the Viterbi path under the character model
   and the channel's costs is taken. A plain word has one reading only and is left as it is.
3. Restored texts of labelled documents are cut into distinct words; counts of toxic and clean
   documents by word and by word beginning give each a posterior share of toxic documents. Marks are
   all words and beginnings whose share is surely high.
4. A document's score is a logistic function of how many of its words carry each mark. Its weights
   are fitted on at most ``SAMPLE`` labelled rows, chosen by md5 of the id. Marks that these rows do
   not have get their log odds over all rows, scaled like the fitted weights.

All counts are Spark aggregates over all rows. What is sent to the tasks has a fixed size (the
character model) or a bounded one (marks and weights); more marks are joined as a table.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import set_aside, with_small
from shelfline.operators import ordered
from shelfline.session import spread, stage_table

#: Letters that a character of leetspeak stands for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
#: Costs of the channel in nats: a leet character, a symbol left out, a drawn-out letter cut, a space left out.
LEET_COST, DROP_COST, CUT_COST, SPACE_COST = 1.0, 7.0, 0.5, 0.7
SIZE = 32
#: After so many places of a long word, what all paths have in common is set aside.
PIECE = 200
DRAWN = re.compile(r"([^\W\d_])\1\1")
EDGES = ".,;:!?\"'()[]{}<>-_/\\&%#~`^=…«»“”„"
WORDS = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(3, 9)
#: A mark needs this many toxic documents, and its posterior share less Z deviations must exceed this.
MIN_TOXIC, MIN_SHARE, Z = 3, 0.5, 1.0
#: So many marks are sent to the tasks; more are joined to the words.
SENT_MARKS = 100_000
#: Labelled rows that the weights are fitted on.
SAMPLE = 40_000


def letter_table() -> np.ndarray:
    """Code point to 1-26 for a-z, 27-31 for other letters, 0 for all else."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x32400):
        char = chr(code)
        if char.isalpha():
            small = ord(char.lower()[0])
            table[code] = small - 96 if 97 <= small <= 122 else 27 + small % 5
    return table


def character_counts(docs: DataFrame) -> np.ndarray:
    """Counts of all letter trigrams of all texts, as an array of SIZE^3: the sum over batches of fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = letter_table()
        for batch in batches:
            total = np.zeros(SIZE**3, np.int64)
            for text in batch["text"]:
                s = table[np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)]
                s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]
                if len(s) > 2:
                    total += np.bincount((s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:], minlength=SIZE**3)
            used = np.flatnonzero(total)
            yield pd.DataFrame({"code": used, "n": total[used]})

    rows = docs.where("text IS NOT NULL").select("text").mapInPandas(count, "code long, n long")
    out = np.zeros(SIZE**3, np.float64)
    for row in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():  # at most SIZE^3 rows
        out[row["code"]] = row["n"]
    return out


def character_costs(counts: np.ndarray) -> list[float]:
    """-log of the interpolated trigram probability by code."""
    three = counts.reshape(SIZE, SIZE, SIZE) + 0.01
    two = three.sum(axis=0)
    one = two.sum(axis=0)
    p = 0.7 * three / three.sum(axis=2, keepdims=True) + 0.25 * (two / two.sum(axis=1, keepdims=True))[None] + 0.05 * (one / one.sum())[None, None]
    return (-np.log(p)).ravel().tolist()


def index_of(char: str) -> int:
    if not char.isalpha():
        return 0
    small = ord(char.lower()[0])
    return small - 96 if 97 <= small <= 122 else 27 + small % 5


def lattice(word: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """Readings of each place of a lower-case word: (output, cost)."""
    places: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(word):
        char, run = word[at], 1
        while at + run < len(word) and word[at + run] == char:
            run += 1
        if spaced and char == " ":
            places.append([(" ", 0.0), ("", SPACE_COST)])
        elif char.isalpha():
            places.append([(char * run, 0.0)] if run < 3 else [(char, CUT_COST), (char * 2, CUT_COST)])
        elif char in LEET:
            readings = [(letter * k, LEET_COST * min(run, 3)) for letter in LEET[char] for k in range(1, min(run, 2) + 1)]
            places.append([*readings, (" ", DROP_COST)])
        else:
            places.append([(" ", 0.0), ("", SPACE_COST)])
        at += run
    return places


def viterbi(places: list[list[tuple[str, float]]], costs: list[float]) -> str:
    """The cheapest reading; ties go to the first in order. Long words keep their paths short, see PIECE."""
    paths, done = {(0, 0): (0.0, "")}, []
    for number, readings in enumerate([*places, [(" ", 0.0)]]):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, out) in paths.items():
            for text, extra in readings:
                x, y, total = a, b, cost + extra
                for char in text:
                    z = index_of(char)
                    if z or y:
                        total += costs[(x * SIZE + y) * SIZE + z]
                        x, y = y, z
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, out + text)
        paths = after
        if number % PIECE == PIECE - 1:
            done.append(os.path.commonprefix([out for _, out in paths.values()]))
            paths = {state: (cost, out[len(done[-1]) :]) for state, (cost, out) in paths.items()}
    return ("".join(done) + min(paths.values())[1]).strip()


class Restorer:
    """Restores texts; words met before are looked up."""

    KEPT = 100_000

    def __init__(self, costs: list[float]):
        self.costs, self.seen = costs, {}

    def word(self, word: str, spaced: bool = False) -> str:
        if (word, spaced) not in self.seen:
            if len(self.seen) >= self.KEPT:
                self.seen.clear()
            self.seen[word, spaced] = viterbi(lattice(word, spaced), self.costs)
        return self.seen[word, spaced]

    def __call__(self, text: str) -> str:
        """Lower-case words of ``text`` as they are meant, joined by spaces."""
        text = text.lower()
        drawn = DRAWN.search(text) is not None
        out, single = [], []
        for token in text.split():
            if not token.isalpha():
                core = token.strip(EDGES)
                one = core or (token if len(token) == 1 else "")
                if len(one) == 1 and (one.isalpha() or one in LEET):
                    single.append(one)
                    continue
                # A bracket or exclamation mark in front may be a letter of a word, but not of a number.
                bare = core if core.isalpha() or not WORDS.search(core) else token.rstrip(EDGES).lstrip(EDGES.replace("(", "").replace("!", ""))
                if single:
                    out.append(self.flush(single))
                    single = []
                out.append(core if bare == core and core.isalpha() and not (drawn and DRAWN.search(core)) else self.mixed(bare))
            elif len(token) == 1:
                single.append(token)
            else:
                if single:
                    out.append(self.flush(single))
                    single = []
                out.append(self.word(token) if drawn and DRAWN.search(token) else token)
        if single:
            out.append(self.flush(single))
        return " ".join(out)

    def mixed(self, token: str) -> str:
        """A word with other characters in it: i-d-i-o-t is spaced out, it's and well-known are words, others, with letters or without, leetspeak."""
        parts, leet = WORDS.findall(token), any(c in LEET for c in token)
        if not parts and not leet:
            return ""
        if len(parts) > 2 and all(len(p) == 1 for p in parts) and not leet:
            return self.flush(parts)
        if not leet and not DRAWN.search(token):
            return " ".join(parts)
        return self.word(token)

    def flush(self, letters: list[str]) -> str:
        return " ".join(c for c in letters if c.isalpha()) if len(letters) < 3 else self.word(" ".join(letters), spaced=True)


def restored_words(docs: DataFrame, costs: list[float]) -> DataFrame:
    """``docs`` with ``_words``: the distinct restored words of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(costs)

    @F.pandas_udf("array<string>")
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = Restorer(sent.value)
        for texts in batches:
            yield pd.Series([sorted(set(WORDS.findall(restore(t)))) if t else [] for t in texts], index=texts.index)

    return docs.withColumn("_words", words("text"))


def _features(word):
    """A word as ' word ' and its beginnings as ' beg'."""
    whole = F.concat(F.lit(" "), word, F.lit(" "))
    begins = [F.when(F.length(word) >= k, F.concat(F.lit(" "), F.substring(word, 1, k))) for k in BEGINNINGS]
    return F.array_compact(F.array(whole, *begins))


#: Table of (mark, weight), its number of rows, intercept.
Model = tuple[DataFrame, int, float]


def _carried(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """(_row, the columns of ``marks``, hits): in how many words of each row of (_row, words) a mark is."""
    each = rows.select("_row", F.explode("words").alias("word")).select("_row", F.explode(_features(F.col("word"))).alias("mark"))
    return each.join(marks, "mark").groupBy("_row", *marks.columns).agg(F.count(F.lit(1)).alias("hits"))


def sampled(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows, those with the smallest md5 of doc_id, ties by doc_id and label; all rows when there are no more.

    A threshold worked out from the count leaves a few more rows than asked for, and only these are ranked,
    over slabs: no task sees more than its share. Should the threshold leave too few, the sample is that much smaller.
    """
    count = rows.count()
    if count <= size:
        return rows
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    margin = 1.05 * size + 10 * math.sqrt(size)
    prefix = F.conv(F.substring(order, 1, 12), 16, 10).cast("long")
    few = rows.where(prefix <= int((1 << 48) * min(1.0, margin / count)))
    ranked = ordered.global_rank(few.withColumn("_order", order), [F.col("_order"), F.col("doc_id"), F.col("toxic"), F.xxhash64("words")], "_rank")
    return ranked.where(F.col("_rank") <= size).drop("_order", "_rank")


def learn(labelled: DataFrame, costs: list[float]) -> Model:
    """The model from rows of (doc_id, text, toxic 0/1). Without toxic rows there are no marks."""
    known = labelled.where("toxic IS NOT NULL").select("doc_id", "text", "toxic")
    words = stage_table(restored_words(known, costs).select("doc_id", "toxic", F.col("_words").alias("words")), "toxic-words")
    base = words.agg(F.avg("toxic")).first()[0] or 0.0
    each = words.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counted = each.select(F.explode(_features(F.col("word"))).alias("mark"), "bad", "good").groupBy("mark").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    a, b = F.col("bad") + 2 * base, F.col("good") + 2 * (1 - base)
    share = a / (a + b)
    bound = share - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    strong = counted.where((F.col("bad") >= MIN_TOXIC) & (bound > MIN_SHARE))
    marks = stage_table(strong.select("mark", F.log(a / b).alias("odds")), "toxic-marks")
    sample = stage_table(spread(sampled(words, SAMPLE)).select("toxic", "words", F.monotonically_increasing_id().alias("_row")), "toxic-sample")
    hits = _carried(sample, marks).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("mark", "odds", "hits"))).alias("hits"))
    rows = sample.select("_row", "toxic").join(hits, "_row", "left").groupBy("toxic", "hits").count().collect()
    odds = {h["mark"]: h["odds"] for r in rows for h in r["hits"] or []}
    number = {mark: k for k, mark in enumerate(sorted(odds))}
    weights, intercept = fit([(r["toxic"], r["count"], [number[h["mark"]] for h in r["hits"] or [] for _ in range(h["hits"])]) for r in rows], len(number))
    fitted = words.sparkSession.createDataFrame(list(zip(number, weights)), "mark string, weight double")
    scale = sum(w * odds[m] for m, w in zip(number, weights)) / (sum(o * o for o in odds.values()) or 1.0)
    weight = F.coalesce("weight", F.col("odds") * (scale if scale > 0 else 1.0)).alias("weight")
    weighed = stage_table(marks.join(fitted, "mark", "left").select("mark", weight), "toxic-weights")
    return weighed, weighed.count(), intercept


def _automaton(marks: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for number, mark in enumerate(marks):
        automaton.add_word(mark, number)
    automaton.make_automaton()
    return automaton


def marks_in(automaton, words: list[str]) -> list[int]:
    """Numbers of the marks in distinct words, once for each word that carries it."""
    if not len(automaton) or not len(words):
        return []
    return sorted(number for _, number in automaton.iter("  ".join(["", *words, ""])))


def strength(hits: int) -> float:
    """A mark in many words of a text says more than in one, but less each time."""
    return math.log2(1 + hits)


def fit(rows: list[tuple[int, int, list[int]]], size: int, penalty: float = 0.0003, turns: int = 1000) -> tuple[list[float], float]:
    """Weights and intercept of a ridge logistic regression over rows of (label, number of rows, hits), by accelerated gradient steps."""
    weight = np.array([n for _, n, _ in rows], np.float64)
    label = np.array([y for y, _, _ in rows], np.float64)
    at, column, value = [], [], []
    for k, (_, _, hits) in enumerate(rows):
        for number, times in sorted(Counter(hits).items()):
            at.append(k)
            column.append(number)
            value.append(strength(times))
    at, column, value = np.array(at, np.int64), np.array(column, np.int64), np.array(value, np.float64)
    w, b, total = np.zeros(size), -2.0, max(1.0, weight.sum())
    if not len(rows) or label.max() == label.min():
        return w.tolist(), -3.0
    # Step length from the largest curvature that a power iteration finds.
    v = np.ones(size)
    largest = 1.0
    for _ in range(20):
        g = np.bincount(column, value * (weight[at] * np.bincount(at, value * v[column], len(rows))[at]), size) if size else v
        largest = float(np.linalg.norm(g)) / total or 1.0
        v = g / (np.linalg.norm(g) or 1.0)
    step = 1 / (0.25 * (largest + 1) + penalty)
    seen_w, seen_b = w.copy(), b
    for turn in range(turns):
        z = np.bincount(at, value * seen_w[column], len(rows)) + seen_b
        slope = weight * (1 / (1 + np.exp(-z)) - label) / total
        new_w = seen_w - step * (np.bincount(column, value * slope[at], size) + penalty * seen_w)
        new_b = seen_b - step * slope.sum()
        pull = turn / (turn + 3)
        seen_w, seen_b, w, b = new_w + pull * (new_w - w), new_b + pull * (new_b - b), new_w, new_b
    return w.tolist(), float(b)


def score(docs: DataFrame, costs: list[float], model: Model) -> DataFrame:
    """``docs`` with ``_score``: 0 to 1. Null and empty texts score like texts without a mark.

    Every row is scored by itself, repeated or not. A column ``_score`` of the input is replaced.
    """
    table, size, intercept = model
    if size > SENT_MARKS:
        return _score_by_join(docs, costs, model)
    listed = table.orderBy("mark").collect()
    sent = docs.sparkSession.sparkContext.broadcast((costs, [r["mark"] for r in listed], [r["weight"] for r in listed]))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own_costs, marks, weights = sent.value
        restore, automaton = Restorer(own_costs), _automaton(marks)
        for texts in batches:
            out = []
            for text in texts:
                total = intercept
                hits = marks_in(automaton, sorted(set(WORDS.findall(restore(text))))) if text else []
                for number, times in Counter(hits).items():
                    total += weights[number] * strength(times)
                out.append(1 / (1 + math.exp(-max(-50.0, min(50.0, total)))))
            yield pd.Series(out, dtype="float64", index=texts.index)

    return docs.withColumn("_score", scored("text"))


def _score_by_join(docs: DataFrame, costs: list[float], model: Model) -> DataFrame:
    """:func:`score` for marks that are too many to send: rows get a name and their words meet the table of marks."""
    marks, _, intercept = model
    rows = stage_table(restored_words(docs, costs).withColumn("_row", F.monotonically_increasing_id()), "scored-words")
    hits = _carried(rows.select("_row", F.col("_words").alias("words")), marks)
    totals = hits.groupBy("_row").agg(F.sum(F.col("weight") * F.log2(1.0 + F.col("hits"))).alias("_total"))
    z = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.coalesce("_total", F.lit(0.0)) + intercept))
    return rows.join(totals, "_row", "left").select(*docs.columns, (1 / (1 + F.exp(-z))).alias("_score"))


def remove_toxic(docs: DataFrame, costs: list[float], model: Model, limit: float = 0.5) -> DataFrame:
    """The rows whose score is below ``limit``, with their columns, whatever their names; null and empty texts stay."""
    docs, back = set_aside(docs, "_score", "_words", "_row", "_total")
    return score(docs, costs, model).where(F.col("_score") < limit).drop("_score").withColumnsRenamed(back)


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[float], Model]:
    """Character costs from all of ``docs`` (doc_id, text), the model from those with a row in ``labels`` (doc_id, toxic).

    Several labels of one document count as toxic when any of them does; null ids match nothing.
    """
    costs = character_costs(character_counts(docs))
    judged = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return costs, learn(with_small(docs.select("doc_id", "text"), judged, "doc_id"), costs)
