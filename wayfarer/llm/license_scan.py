"""License scan: fuzzy search for short notices.

A notice of n characters that occurs with at most k edits contains, unchanged, one of any k + 1
pieces it is cut into (pigeonhole). One Aho-Corasick pass over the word-normalised text finds all
pieces of all notices; the neighbourhood of a piece is then matched with the ``regex`` library's
bounded-error patterns, which verifies the edits and gives the span. The phrases of the result
contract are the notices with k = 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the result contract.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Short notices searched with edits: text, label.
NOTICES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("licensed under the bsd license", "bsd"),
    ("creative commons attribution", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "proprietary"),
)

# ASCII letters to lower case, every other ASCII character but digits to a space.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def errors_allowed(notice: str) -> int:
    """One edit for each 15 characters, one at least and three at most."""
    return min(3, max(1, len(notice) // 15))


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of errors + 1 pieces of nearly equal length."""
    cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int
    base: bool


class NoticeSearch:
    """The automaton of all seeds and the bounded-error pattern of each notice."""

    def __init__(self, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]):
        self.notices = [Notice(f" {t} ", label, 0, True) for t, label in base]
        self.notices += [Notice(t, label, errors_allowed(t), False) for t, label in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            for offset, piece in pieces(n.text, n.errors):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.errors}}}")
                         for n in self.notices]

    def find(self, norm: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in ``norm``; of a notice non-overlapping, leftmost first.
        Base notices are reported at all places."""
        found = []
        windows: dict[int, list[list[int]]] = {}
        for last, (length, uses) in self.automaton.iter(norm):
            first = last - length + 1
            for i, offset in uses:
                n = self.notices[i]
                if n.errors == 0:  # the one piece is the whole notice
                    found.append((i, first, last + 1, 0))
                    continue
                a, b = max(0, first - offset - n.errors), first - offset + len(n.text) + n.errors
                spans = windows.setdefault(i, [])
                if spans and a <= spans[-1][1] and a >= spans[-1][0]:
                    spans[-1][1] = max(spans[-1][1], b)
                else:
                    spans.append([a, b])
        for i, spans in windows.items():
            at = 0
            for a, b in sorted(spans):
                for m in self.patterns[i].finditer(norm, max(a, at), min(b, len(norm))):
                    found.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
                    at = m.end()
        return found


@lru_cache(maxsize=4)
def _search(base: tuple, notices: tuple) -> NoticeSearch:
    return NoticeSearch(base, notices)


def byte_spans(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the words of a text, for mapping matches back to it."""
    spans, flat, at = [], text.translate(_BYTES), 0
    for w in flat.split():
        at = flat.index(w, at)
        spans.append((at, at + len(w)))
        at += len(w)
    return spans


def code_points(text: bytes, positions: Sequence[int]) -> dict[int, int]:
    """Code points before each of the ascending byte positions, in one pass."""
    out, before, count = {}, 0, 0
    for p in positions:
        count += len(text[before:p].decode("utf-8", "surrogatepass"))
        out[p], before = count, p
    return out


def scan_text(text: str | None, search: NoticeSearch) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_BYTES).split()
    norm = (b" " + b" ".join(words) + b" ").decode("utf-8", "surrogatepass")
    found = search.find(norm) if words else []
    if not found:
        return len(words), 0, None, None, "", "", 0.0, ""
    # of each word in norm; a word may hold white space that is not ASCII
    begins = list(accumulate((len(w) + 1 for w in norm[1:-1].split(" ")), initial=1))
    hits = []
    for i, a, b, edits in found:
        a, b = a + (norm[a] == " "), b - (norm[b - 1] == " ")
        hits.append((bisect_right(begins, a) - 1, bisect_right(begins, b - 1) - 1, edits, search.notices[i]))
    where = byte_spans(raw)
    points = code_points(raw, sorted({p for first, last, *_ in hits for p in (where[first][0], where[last][1])}))
    starts = [first for first, _, _, n in hits if n.base]
    spans = {(points[where[first][0]], points[where[last][1]], n.label) for first, last, _, n in hits}
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({n.label for *_, n in hits if n.base})), ",".join(sorted({n.label for *_, n in hits})),
            max(1.0 - edits / len(n.text.strip()) for _, _, edits, n in hits),
            ",".join(f"{label}:{a}:{b}" for a, b, label in sorted(spans)))


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")


def license_scan(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE_PHRASES,
                 notices: Sequence[tuple[str, str]] = NOTICES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, n_base (all places of the base phrases),
    first_word and last_word (their smallest and largest start, else NULL), base_labels, labels
    (base phrases' and notices', sorted), score (1 less the share of edited characters of the best
    match, 0 without one) and spans (``label:start:end`` in code points of the text; matches of
    notices cover whole words).

    NULL counts as empty: no words, no match, score 0. Repeated rows give repeated results; an
    empty table gives an empty one. Other columns are not read. Each row is judged by itself, so
    any split of the table gives the same result.
    """
    base, notices = tuple(base), tuple(notices)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = _search(base, notices)
        for batch in batches:
            rows = [scan_text(t, search) for t in batch["_text"]]
            out = pd.DataFrame(rows, columns=list(COLUMNS)).astype(
                {"n_words": "int64", "n_base": "int64", "first_word": "Int64", "last_word": "Int64"})
            out.insert(0, "_id", batch["_id"].to_numpy())
            yield out

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text")).mapInPandas(
        scan, "_id string, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans string")
    return out.select(F.col("_id").cast(id_type).alias(id_col), *COLUMNS)
