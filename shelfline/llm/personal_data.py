"""Personal data: four fixed patterns, and a skip-chain conditional random field that adds to them.

*Base.* Emails, ip addresses, card and phone numbers by fixed patterns. They are searched so that
each character is looked at a bounded number of times, however long the text or a word in it is.

*Field.* Sites are the words of a text that hold a digit, an ``@`` or ``[at]``; other words cannot
carry a label. Labels are "none" and the four kinds. The field has three sorts of potentials:

* unary: a site's shape (digits, letters, punctuation, checksum and so on) and the sides on which it has a neighbour,
* chain: two sites that are neighbouring words,
* skip: a site and its *anchor*, the first site that the base marks among those of the document with
  the same key, or the first one at all. Keys are equal for repeated tokens and for similar ones:
  a card with other separators, a phone number with or without its prefix, an address with ``[at]``.

*Fit.* Each sort is fitted by itself (piecewise training) on counts over all documents, with the base
as teacher: chain and skip potentials are smoothed pointwise mutual information, unary weights are a
multinomial regression on the counts of shapes. A site that the base leaves out although its
match runs over it, or although it is similar to one that the base marks, is unlabelled rather than
negative and is not counted. Shapes and labels have few values, so the counts have a bound that
does not depend on the corpus.

*Use.* Sites of base spans are fixed; the others get their marginals from loopy message passing over
chain and skip edges, a fixed number of rounds, so that a document's result does not depend on what
lies in its batch. A site whose best label is a kind gives an added span.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NONE = 0  # label; kind k has label k + 1
LABELS = 1 + len(KINDS)
#: A label that is not known: in the fit it takes part in no count.
UNLABELLED = -1
ROUNDS = 20
#: Added to each count of a pair of labels.
SMOOTHING = 0.5
#: Pairs of a site and its anchor that count as seen with each label, so that they agree before any is.
AGREEMENT = 10.0
#: Blanks and punctuation that may lie between neighbouring words.
GAP = 8
#: Digits that an added span needs, and may have when it is put together from several words.
LEAST, MOST = {"card": 12, "phone": 7}, {"card": 19, "phone": 15}
#: Steps of the regression, and its penalty in documents' worth of evidence.
STEPS, PENALTY = 1500, 1.0

BLANK = re.compile(r"[\x20\x09-\x0D]")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins with a whole run of digits: a later digit of the run would meet the same end.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[^0-9]+")
_MARK = re.compile(r"[0-9@]|[\[(][aA][tT][\])]")
_AT = re.compile(r"[\[(][aA][tT][\])]")
_TRIM = ".,;:!?\"'<>%#$&*~`|[]{}"


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if place % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for host in _HOST.finditer(text):
        start = at = host.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = host.end()
            yield start, done


def matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, kept) of every match of the base patterns; those that fail their check are not kept."""
    for start, end in _emails(text):
        yield 0, start, end, True
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        yield 1, m.start(), m.end(), all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)
    for m in _CARD.finditer(text):
        count = m.end() - m.start() - m.group().count(" ") - m.group().count("-")
        yield 2, m.start(), m.end(), 14 <= count <= 19 and luhn(_DIGITS.sub("", m.group()))
    for m in _PHONE.finditer(text):
        yield 3, m.start(), m.end(), 10 <= len(_DIGITS.sub("", m.group())) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the spans that the fixed patterns keep, in order."""
    return sorted((start, kind, end) for kind, start, end, kept in matches(text) if kept)


def sites(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an at sign, without punctuation around them."""
    out, done = [], 0
    mark = _MARK.search(text)
    while mark:
        start = mark.start()
        while start > done and not BLANK.match(text, start - 1):
            start -= 1
        blank = BLANK.search(text, mark.end())
        done = blank.start() if blank else len(text)
        word = text[start:done]
        left = len(word) - len(word.lstrip(_TRIM))
        end = start + max(left + 1, len(word.rstrip(_TRIM)))
        out.append((start + left, end))
        mark = _MARK.search(text, done)
    return out


def _bucket(n: int, bounds: Sequence[int]) -> int:
    return sum(n >= b for b in bounds)


def shape(word: str) -> tuple[int, ...]:
    """Small numbers that describe a word; each has at most ten values."""
    plain = _AT.sub("@", word)  # an at sign in brackets is one, and told apart by one number only
    digits = _DIGITS.sub("", plain)
    other = len(plain) - len(digits)
    letters = sum(map(str.isalpha, plain)) if other else 0
    dots, at = plain.count("."), plain.count("@")
    return (
        _bucket(len(digits), (1, 2, 3, 4, 5, 7, 10, 14, 20)),
        _bucket(letters, (1, 4)) if not at else 3,
        min(dots, 4) if not letters or at else 5,
        min(plain.count("-"), 3),
        int(plain.startswith("+")) + 2 * int("(" in plain or ")" in plain),
        min(at, 2),
        int(plain != word),
        int(at == 1 and next(_emails(plain), None) is not None),
        (1 + luhn(digits)) if 14 <= len(digits) <= 19 and not letters else 0,
        _octets(word) if dots == 3 and not letters else 0,
        min(other - letters - dots - at, 5),
    )


def _octets(word: str) -> int:
    m = _IP.fullmatch(word)
    return 0 if m is None else 1 + next(kept for kind, _, _, kept in matches(word) if kind == 1)


def key(word: str) -> str | None:
    """Equal for repeated and for similar words; None for words too short to tell."""
    if "@" in word or _AT.search(word):
        return "@" + "".join(c for c in _AT.sub("@", word).lower() if c.isalnum() or c == "@")
    if any(map(str.isalpha, word)):
        return "w" + word.lower() if len(word) >= 7 else None
    digits = _DIGITS.sub("", word)
    if word.count(".") == 3 and len(digits) <= 12:
        return "i" + word
    return None if len(digits) < 7 else "c" + digits if len(digits) >= 14 else "p" + digits[-7:]


class Sites:
    """Sites of one text: places, shapes, the base's labels, chain neighbours and anchors."""

    def __init__(self, text: str):
        self.places = sites(text)
        found = sorted((start, end, kind, kept) for kind, start, end, kept in matches(text)) if self.places else []
        self.base = sorted((start, kind, end) for start, end, kind, kept in found if kept)
        n = len(self.places)
        self.words = [text[a:b] for a, b in self.places]
        self.labels = [NONE] * n
        doubtful = [False] * n
        first = 0
        for start, end, kind, kept in found:
            while first < n and self.places[first][1] <= start:
                first += 1
            k, inside = first, []
            while k < n and self.places[k][0] < end:
                inside.append(k)
                k += 1
            for k in inside:
                if not kept:
                    doubtful[k] |= len(inside) > 1
                elif self.labels[k] == NONE:
                    self.labels[k] = kind + 1
        self.next = [k + 1 < n and self._adjoin(text[self.places[k][1] : min(self.places[k + 1][0], self.places[k][1] + GAP + 1)]) for k in range(n)]
        self.anchors = self._anchors()
        self.taught = [
            UNLABELLED if own == NONE and (d or (a >= 0 and self.labels[a] != NONE)) else own
            for own, d, a in zip(self.labels, doubtful, self.anchors)
        ]

    @staticmethod
    def _adjoin(between: str) -> bool:
        return len(between) <= GAP and not between.strip(_TRIM + "() \t\n\x0b\x0c\r")

    def form(self, k: int) -> tuple[int, ...]:
        """The shape of site k, and on which sides it has a neighbour."""
        return (*shape(self.words[k]), int(k > 0 and self.next[k - 1]) + 2 * int(self.next[k]))

    def _anchors(self) -> list[int]:
        keys, first = [key(w) for w in self.words], {}
        for marked in (True, False):
            for k, name in enumerate(keys):
                if name is not None and (not marked or self.labels[k] != NONE):
                    first.setdefault(name, k)
        return [first[name] if name is not None and first[name] != k else -1 for k, name in enumerate(keys)]


def counts(texts: DataFrame) -> DataFrame:
    """(piece, cell, n): how often each cell occurs in all texts. Pieces are ``unary`` (shape, label), ``chain`` and ``skip`` (two labels)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                own = Sites(text or "")
                for k, label in enumerate(own.taught):
                    if label == UNLABELLED:
                        continue
                    seen["unary", (*own.form(k), label)] += 1
                    if own.next[k] and own.taught[k + 1] != UNLABELLED:
                        seen["chain", (label, own.taught[k + 1])] += 1
                    if own.anchors[k] >= 0 and own.taught[own.anchors[k]] != UNLABELLED:
                        seen["skip", (own.taught[own.anchors[k]], label)] += 1
        if seen:
            yield pd.DataFrame({"piece": [p for p, _ in seen], "cell": [list(c) for _, c in seen], "n": list(seen.values())})

    found = texts.select("text").mapInPandas(count, "piece string, cell array<int>, n long")
    return found.groupBy("piece", "cell").agg(F.sum("n").alias("n"))


class Field:
    """Potentials: ``weights`` of shape values, and log potentials of label pairs for ``chain`` and ``skip``."""

    def __init__(self, cells: Sequence[tuple[str, Sequence[int], int]]):
        by = {piece: sorted((tuple(c), n) for p, c, n in cells if p == piece) for piece in ("unary", "chain", "skip")}
        self.chain, self.skip = self._shared(by["chain"], 0.0), self._shared(by["skip"], AGREEMENT)
        shapes = sorted({c[:-1] for c, _ in by["unary"]})
        self.places: dict[tuple[int, int], int] = {}
        for own in shapes:
            for item in enumerate(own):
                self.places.setdefault(item, len(self.places))
        table = np.zeros((len(shapes), LABELS))
        row = {own: k for k, own in enumerate(shapes)}
        for cell, n in by["unary"]:
            table[row[cell[:-1]], cell[-1]] += n
        self.weights = self._regression(np.array([self._features(own) for own in shapes]).reshape(len(shapes), len(self.places) + 1), table)

    def _features(self, own: tuple[int, ...]) -> np.ndarray:
        x = np.zeros(len(self.places) + 1)
        x[-1] = 1
        for item in enumerate(own):
            if item in self.places:
                x[self.places[item]] = 1
        return x

    @staticmethod
    def _shared(cells: list, agreement: float) -> np.ndarray:
        n = np.full((LABELS, LABELS), SMOOTHING) + agreement * np.eye(LABELS)
        for (a, b), count in cells:
            n[a, b] += count
        return np.log(n * n.sum() / (n.sum(1, keepdims=True) * n.sum(0, keepdims=True)))

    @staticmethod
    def _regression(x: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Multinomial logistic weights by Adam over all cells; none when there is nothing to learn from."""
        total = table.sum()
        if not total:
            w = np.zeros((LABELS, 1))
            w[NONE] = 1
            return w
        w = np.zeros((LABELS, x.shape[1]))
        speed, size, rows = np.zeros_like(w), np.zeros_like(w), table.sum(1, keepdims=True)
        for step in range(1, STEPS + 1):
            score = x @ w.T
            score -= score.max(1, keepdims=True)
            share = np.exp(score)
            share /= share.sum(1, keepdims=True)
            slope = ((share * rows - table).T @ x + PENALTY * w) / total
            speed = 0.9 * speed + 0.1 * slope
            size = 0.999 * size + 0.001 * slope * slope
            w -= 0.05 * (speed / (1 - 0.9**step)) / (np.sqrt(size / (1 - 0.999**step)) + 1e-12)
        return w

    def unary(self, own: tuple[int, ...]) -> np.ndarray:
        return self.weights @ self._features(own)


def _normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def marginals(unary: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of sites by loopy message passing over edges (left, right) with log potentials ``pairs``, edges x labels x labels.

    Exact on trees whose paths are shorter than ``rounds``.
    """
    forward, backward = np.zeros((len(left), LABELS)), np.zeros((len(left), LABELS))

    def beliefs() -> np.ndarray:
        out = unary.copy()
        np.add.at(out, right, forward)
        np.add.at(out, left, backward)
        return out

    for _ in range(rounds):
        now = beliefs()
        ahead = (now[left] - backward)[:, :, None] + pairs
        back = (now[right] - forward)[:, None, :] + pairs
        forward, backward = (_normal(np.logaddexp.reduce(m, axis=axis)) for m, axis in ((ahead, 1), (back, 2)))
    return np.exp(_normal(beliefs()))


def added_spans(found: list[Sites], field: Field) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the spans that the field adds to each text's base."""
    offsets = np.cumsum([0] + [len(s.places) for s in found])
    if not offsets[-1]:
        return [[] for _ in found]
    cache: dict[tuple[int, ...], np.ndarray] = {}
    unary, left, right, pairs = np.empty((offsets[-1], LABELS)), [], [], []
    for at, own in zip(offsets, found):
        for k in range(len(own.places)):
            if own.labels[k] == NONE:
                form = own.form(k)
                if form not in cache:
                    cache[form] = field.unary(form)
                unary[at + k] = cache[form]
            else:
                unary[at + k] = -1e6
                unary[at + k, own.labels[k]] = 0
            for other, potential in ((k + 1 if own.next[k] else -1, field.chain), (own.anchors[k], field.skip)):
                # Between two fixed sites there is nothing to tell.
                if other >= 0 and NONE in (own.labels[k], own.labels[other]):
                    first, second = (k, other) if potential is field.chain else (other, k)
                    left.append(at + first)
                    right.append(at + second)
                    pairs.append(potential)
    share = marginals(unary, np.array(left, int), np.array(right, int), np.array(pairs).reshape(-1, LABELS, LABELS))
    best = np.where(share.max(1) > 0.5, share.argmax(1), NONE)
    out = []
    for at, own in zip(offsets, found):
        spans, digits = [], []
        for k, (start, end) in enumerate(own.places):
            label = int(best[at + k])
            if own.labels[k] != NONE or label == NONE:
                continue
            kind, count = label - 1, len(_DIGITS.sub("", own.words[k]))
            joins = spans and k and own.next[k - 1] and spans[-1][1] == kind and spans[-1][2] == own.places[k - 1][1]
            if joins and digits[-1] + count <= MOST.get(KINDS[kind], 0):
                spans[-1], digits[-1] = (spans[-1][0], kind, end), digits[-1] + count
            else:
                spans.append((start, kind, end))
                digits.append(count)
        out.append([s for s, n in zip(spans, digits) if n >= LEAST.get(KINDS[s[1]], 0)])
    return out


def learn(docs: DataFrame) -> Field:
    """The field of all rows of (text). Null and empty texts, and texts without sites, count nothing."""
    return Field([tuple(r) for r in counts(docs).collect()])


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, field: Field, name: str = "found") -> DataFrame:
    """``docs`` with a column ``name``: ``base`` and ``spans`` (base and added), each by start, then kind.

    Places count code points, ends are exclusive. Null and empty texts have none. Every row is looked
    at by itself; all columns other than ``name`` are left alone.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(f"struct<base:{SPANS},spans:{SPANS}>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        named = lambda rows: [{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in rows]
        for texts in batches:
            found = [Sites(t or "") for t in texts]
            more = added_spans(found, sent.value)
            yield pd.DataFrame({"base": [named(s.base) for s in found], "spans": [named(sorted(s.base + a)) for s, a in zip(found, more)]}, index=texts.index)

    return docs.withColumn(name, spans("text"))


def report(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of (doc_id, text); the counts are the base's."""
    found = find(docs.select("doc_id", "text"), field).select("doc_id", "found.base", "found.spans")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
