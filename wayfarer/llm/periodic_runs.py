"""Runs of repeated words, found online by dyadic square catching.

A square is a stretch of words that is said twice in a row. Its first half, of ``p`` words, covers an
aligned block of ``2**k`` words for the ``k`` with ``2 * 2**k <= p < 4 * 2**k``. So a catcher sits on
each block of a power of two words as soon as the block is complete, and lies in wait until the text
is four blocks on. Each word that is appended completes one suffix of every power-of-two length; the
suffix is compared with the two blocks of its length whose catchers are awake. On a hit the comparison
runs on to both sides, to the right as far as words have come and further with each append. A stretch
that reaches two periods is a new square, squares of one period that overlap are one run, and a run
ends at the first word that breaks its period.

Words may be appended one at a time or many together; the catchers advance over many with numpy and
find the same runs.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH, MIN_EXPONENT = 24, 3  # of a run: words, and periods in it
SLICE_WORDS = 1 << 18  # texts of about so many words together go through one set of catchers
HITS = 1 << 18  # hits whose comparisons run on together

Runs = list[tuple[int, int, int]]


class SquareCatchers:
    """Catchers over the completed power-of-two blocks of a growing text.

    ``append`` takes numbered words (equal numbers: equal words) and ``finish`` ends the text. ``runs``
    then holds (start, end, period) of each maximal stretch of two periods or more, with its smallest
    period. A number below zero equals nothing, itself included: it separates texts. ``longest``
    bounds the words between two separators, if known, so that longer blocks are left out.

    Suffixes are compared by 64-bit hashes, kept for all lengths of a power of two: 8 bytes for each
    word and level. Runs are checked word by word at the end, so a collision cannot make a wrong one.
    """

    def __init__(self, longest: int | None = None, seed: int = 0):
        self.top = None if longest is None else max(0, (longest // 4).bit_length() - 1)
        self.keys = np.random.default_rng([seed, 7]).integers(1 << 62, 1 << 63, 4, dtype="u8") | np.uint64(1)
        self.words = np.zeros(0, "i8")
        self.levels: list[np.ndarray] = []  # of each block length, the hashes of all its stretches
        self.awaiting: list[int] = []  # of each block length, the first stretch not yet compared
        self.open = np.zeros((0, 2), "i8")  # (start, period) of matches that reach the last word
        self.closed: list[np.ndarray] = []  # (start, end, period) of squares that ended
        self.apart = 0

    def _mix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * self.keys[0] + b * self.keys[1]
        x ^= x >> np.uint64(29)
        x *= self.keys[2]
        x ^= x >> np.uint64(32)
        return x

    def append(self, numbers: np.ndarray) -> None:
        numbers = np.asarray(numbers, "i8")
        before = len(self.words)
        apart = np.flatnonzero(numbers < 0)
        words = numbers.copy()
        words[apart] = -1 - self.apart - np.arange(len(apart))  # each separator a word of its own
        self.apart += len(apart)
        self.words = np.concatenate([self.words, words])
        self._grow(words.view("u8"))
        self._advance(before)
        self._merge(h for k in range(len(self.levels)) for h in self._catch(k))

    def _grow(self, new: np.ndarray) -> None:
        """Hashes of the stretches that the new words complete, for every block length."""
        n = len(self.words)
        first = self._mix(new, np.full(len(new), self.keys[3]))
        if not self.levels:
            self.levels, self.awaiting = [np.zeros(0, "u8")], [1]
        self.levels[0] = np.concatenate([self.levels[0], first])
        k = 1
        while 4 << k <= n and (self.top is None or k <= self.top):
            half, low = 1 << (k - 1), self.levels[k - 1]
            if k == len(self.levels):
                self.levels.append(np.zeros(0, "u8"))
                self.awaiting.append(2 << k)
            at = len(self.levels[k])
            here = low[at: len(low) - half]
            self.levels[k] = np.concatenate([self.levels[k], self._mix(here, low[at + half: at + half + len(here)])])
            k += 1

    def _ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on (``a < b``)."""
        far = np.zeros(len(a), "i8")
        for k in range(len(self.levels) - 1, -1, -1):
            h, size, live = self.levels[k], 1 << k, np.arange(len(a))
            while len(live):
                x, y = a[live] + far[live], b[live] + far[live]
                inside = y < len(h)
                same = np.zeros(len(live), bool)
                same[inside] = h[x[inside]] == h[y[inside]]
                live = live[same]
                far[live] += size
                if k < len(self.levels) - 1:  # a second step would be one of the longer blocks
                    break
        return far

    def _behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree before ``a`` and ``b`` (``a < b``)."""
        far = np.zeros(len(a), "i8")
        for k in range(len(self.levels) - 1, -1, -1):
            h, size, live = self.levels[k], 1 << k, np.arange(len(a))
            while len(live):
                x, y = a[live] - far[live] - size, b[live] - far[live] - size
                inside = x >= 0
                inside &= y < len(h)
                same = np.zeros(len(live), bool)
                same[inside] = h[x[inside]] == h[y[inside]]
                live = live[same]
                far[live] += size
                if k < len(self.levels) - 1:
                    break
        return far

    def _advance(self, before: int) -> None:
        """Matches that reached the last word go on through the new ones."""
        if len(self.open):
            start, period = self.open.T
            end = before + self._ahead(np.full(len(start), before) - period, np.full(len(start), before))
            self._keep(start, end, period)

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Matches that reach the last word stay open; of the others, squares are kept."""
        opened = end == len(self.words)
        self.open = np.column_stack([start[opened], period[opened]])
        square = ~opened & (end - start >= 2 * period)
        if square.any():
            self.closed.append(np.column_stack([start[square], end[square], period[square]]))

    def _catch(self, k: int) -> Iterator[np.ndarray]:
        """(block start, period) of the blocks of ``2**k`` words that the new suffixes repeat."""
        h, size, first = self.levels[k], 1 << k, self.awaiting[k]
        self.awaiting[k] = max(first, len(h))
        for a in range(first, len(h), HITS):
            at = np.arange(a, min(a + HITS, len(h)))
            for back in ((2, 3) if k else (1, 2, 3)):  # the awake catchers: blocks that began so many blocks ago
                block = ((at >> k) - back) << k
                hit = np.flatnonzero(h[np.maximum(block, 0)] == h[at])
                hit = hit[block[hit] >= 0]
                if len(hit):
                    yield np.column_stack([block[hit], at[hit] - block[hit]])

    def _merge(self, found: Iterator[np.ndarray]) -> None:
        """The comparisons of hits run on to both sides; matches of one period and start are one."""
        parts = [np.column_stack([self.open[:, 0], np.full(len(self.open), len(self.words)), self.open[:, 1]])]
        for some in found:
            block, period = some.T
            start = block - self._behind(block, block + period)
            end = block + period + self._ahead(block, block + period)
            near = end - start >= 2 * period
            near |= end == len(self.words)
            parts.append(np.unique(np.column_stack([start, end, period])[near], axis=0))
        rows = np.unique(np.concatenate(parts), axis=0)
        self._keep(*rows.T)
        self._drop_multiples()

    def _drop_multiples(self) -> None:
        """An open match whose period is a multiple of another's with its start ends where that ends."""
        rest, kept = self.open[np.lexsort(self.open.T[::-1])], []
        while len(rest):
            lead = np.append(True, rest[1:, 0] != rest[:-1, 0])
            smallest = rest[lead][np.cumsum(lead) - 1, 1]
            kept.append(rest[lead])
            rest = rest[rest[:, 1] % smallest != 0]
        self.open = np.concatenate(kept) if kept else self.open

    def finish(self) -> None:
        start, period = self.open.T
        end = np.full(len(start), len(self.words))
        square = end - start >= 2 * period
        self.closed.append(np.column_stack([start, end, period])[square])
        self.open = self.open[:0]
        rows = np.concatenate(self.closed)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        # a multiple of a run's period gives the same stretch again: its smallest period is the run's
        self.runs = rows[np.append(np.ones(min(len(rows), 1), bool), (rows[1:, :2] != rows[:-1, :2]).any(axis=1))]

    def right(self, rows: np.ndarray) -> bool:
        """Whether ``rows``, runs of the text, are stretches of their period that no neighbour extends."""
        w, n = self.words, len(self.words)
        return all(np.array_equal(w[a: b - p], w[a + p: b]) and (a == 0 or w[a - 1] != w[a - 1 + p])
                   and (b == n or w[b] != w[b - p]) for a, b, p in rows.tolist())


def runs_of(texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
            chunk: int = SLICE_WORDS) -> list[Runs]:
    """(start, length, period) of the runs of each text of numbered words, by start, then period: the
    stretches with ``min_length`` words and ``min_exponent`` (two or more) periods at least."""
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    stream = np.concatenate([x for t in texts for x in (t, [-1])]) if texts else np.zeros(0, "i8")
    for seed in count():
        catchers = SquareCatchers(max(map(len, texts), default=0), seed)
        for a in range(0, len(stream), chunk):
            catchers.append(stream[a: a + chunk])
        catchers.finish()
        rows = catchers.runs
        length = rows[:, 1] - rows[:, 0]
        rows = rows[length >= np.maximum(min_length, min_exponent * rows[:, 2])]
        if catchers.right(rows):  # else two stretches had one hash: other hashes
            break
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    out: list[Runs] = [[] for _ in texts]
    for k, (a, b, p) in zip((np.searchsorted(begins, rows[:, 0], "right") - 1).tolist(), rows.tolist(), strict=True):
        out[k].append((a - int(begins[k]), b - a, p))
    return out


def words_of(text: str) -> list[bytes]:
    """What lies between runs of ASCII white space, in UTF-8: bytes know no other white space."""
    return text.encode("utf-8", "surrogatepass").split()


Order = Callable[[object, int], np.ndarray | None]


def said_again(doc_id: object, n: int) -> np.ndarray | None:
    """The result contract's order of a document's ``n`` words: of one document in ten, chosen by its id's
    CRC, the words from some place on are said again and again. None: as they are, also without an id."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def kept_words(words: list[bytes], runs: Runs) -> list[bytes]:
    """``words`` without those that a run says again: what follows its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, "i8")
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def _slices(sizes: list[int], size: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for k, s in enumerate(sizes):
        total += s
        if total >= size:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def periodic_runs(docs: DataFrame, order: Order | None = None, min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, runs (an array of start, length, period, in words,
    by start, then period) and collapsed (the words that no run says again, joined by one space).

    Words are what lies between ASCII white space. A run is a stretch with ``min_length`` words and
    ``min_exponent`` of its smallest periods at least that no neighbouring word extends. ``order``, if
    given, takes an id and a number of words and returns the order in which the words are read, or None
    as they are.

    NULL counts as a text without words: no runs, collapsed is empty; so do empty texts. Rows that
    repeat an id or a text are judged each by itself, also without an id. An empty table gives an empty
    result. Other columns are not read. No row is shuffled; a task holds one batch of texts, and about
    8 bytes for each word and power of two up to a quarter of its longest text.
    """
    id_type = docs.schema[id_col].dataType
    whole = id_type.simpleString() in ("tinyint", "smallint", "int", "bigint")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch["_text"]]
            ids = [None if i is None else int(i) if whole else i for i in batch["_id"]]
            for a, b in _slices([len(t) for t in texts], 6 * SLICE_WORDS):
                number: dict[bytes, int] = defaultdict()
                number.default_factory = number.__len__  # a new word gets the next number
                said, numbered = [], []
                for i, t in zip(ids[a:b], texts[a:b], strict=True):
                    w = words_of(t)
                    x = np.fromiter(map(number.__getitem__, w), "i8", len(w))
                    if order is not None and (new := order(i, len(w))) is not None:
                        x, w = x[new], [w[k] for k in new.tolist()]
                    said.append(w)
                    numbered.append(x)
                found = runs_of(numbered, min_length, min_exponent)
                yield pd.DataFrame({
                    "_id": batch["_id"].iloc[a:b].to_numpy(), "n_words": [len(w) for w in said],
                    "runs": [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found],
                    "collapsed": [b" ".join(kept_words(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(said, found, strict=True)]})

    out = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text")).mapInPandas(
        find, "_id string, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.select(F.col("_id").cast(id_type).alias(id_col), "n_words", "runs", "collapsed")


def run_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The result contract's columns of ``periodic_runs``: the run with the most periods, exactly (of several
    the first, then that of the smallest period; NULLs without a run) and digests."""
    id_type = found.schema[id_col].dataType
    rows = found.select(F.col(id_col).cast("string").alias("_id"), "n_words", "runs",
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    listed = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))")
    # the most periods by cross-multiplication; decimals hold the products
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) -> CASE
        WHEN b IS NULL OR cast(r.length as decimal(19, 0)) * b.period > cast(b.length as decimal(19, 0)) * r.period
        THEN r ELSE b END)""")
    rows = rows.withColumn("_best", best)
    return rows.select(
        F.col("_id").cast(id_type).alias(id_col), F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length",
        "_best.period", F.expr("cast(1000 * _best.length div _best.period as bigint)").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), "collapsed_sha256", "n_words")
