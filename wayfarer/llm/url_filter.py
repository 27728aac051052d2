"""URL filter: rules in a sorted array of 64-bit xxhash keys, probed by binary search.

The index is one file: the sorted digests, and behind them the offsets and bytes of the full rule
strings. ``SparkContext.addFile`` hands it to every executor (also to one that joins later), where
tasks memory-map it, so its pages are shared by an executor's Python workers. A URL is probed with
each (host suffix, path prefix) pair whose prefix length occurs among the rules; every digest hit
is confirmed against the stored string, so a digest collision never decides.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The rules of the result contract, (host, path) written together, with the verdict.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
DEFAULT_VERDICT = "allow"  # of a URL that no rule fits

_URL = re.compile(r"\A.*?://([^/?#]*)([^?#]*)", re.S)
_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HEAD = struct.Struct("<4sIQ")  # magic, number of path lengths, number of entries
_MAGIC = b"URL1"


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    then up to ``?``, ``#`` or the end. NULL, or a text without ``://``: both empty."""
    m = _URL.match(url) if url else None
    return (m[1].translate(_TO_LOWER), m[2]) if m else ("", "")


def index_bytes(rules: Iterable[tuple[str, str]]) -> bytes:
    """The index of ``rules`` (rule, verdict) as a file's content. Of a repeated rule the last counts."""
    by_rule = {}
    for rule, verdict in rules:
        host, slash, path = rule.partition("/")
        by_rule[f"{host.translate(_TO_LOWER)}{slash}{path}"] = verdict
    entries = sorted((xxhash.xxh64_intdigest(r), r.encode(), v) for r, v in by_rule.items())
    lengths = sorted({len(r.partition("/")[1] + r.partition("/")[2]) for r in by_rule})
    blobs = [r for _, r, _ in entries]
    offsets = np.cumsum([0, *map(len, blobs)], dtype="<u8")
    return b"".join([
        _HEAD.pack(_MAGIC, len(lengths), len(entries)),
        np.array(lengths, "<u8").tobytes(),
        np.array([d for d, _, _ in entries], "<u8").tobytes(),
        offsets.tobytes(),
        np.array([v == "block" for _, _, v in entries], "u1").tobytes(),
        *blobs,
    ])


class DigestIndex:
    """A memory-mapped index file; holds nothing in memory but views of the map."""

    def __init__(self, path: str):
        self.raw = np.memmap(path, dtype="u1", mode="r")
        magic, k, n = _HEAD.unpack(self.raw[: _HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"not a URL index: {path}")
        at = _HEAD.size
        self.lengths = np.frombuffer(self.raw, "<u8", k, at)
        self.digests = np.frombuffer(self.raw, "<u8", n, at + 8 * k)
        self.offsets = np.frombuffer(self.raw, "<u8", n + 1, at + 8 * (k + n))
        self.blocks = np.frombuffer(self.raw, "u1", n, at + 8 * (k + 2 * n + 1))
        self.text_at = at + 8 * (k + 2 * n + 1) + n

    def entry(self, i: int) -> bytes:
        return self.raw[self.text_at + int(self.offsets[i]): self.text_at + int(self.offsets[i + 1])].tobytes()

    def keys(self, host: str, path: str) -> Iterator[str]:
        """Every rule string that could fit, the longest first for each host."""
        if not host:
            return
        labels = host.split(".")
        prefixes = [path[:n] for n in self.lengths[::-1].tolist() if n <= len(path)]
        for i in range(len(labels)):
            suffix = ".".join(labels[i:])
            for p in prefixes:
                yield suffix + p

    def probe(self, parts: Sequence[tuple[str, str]]) -> tuple[list[str | None], list[str | None]]:
        """Longest fitting rule and its verdict for each (host, path), else None."""
        rows, keys = [], []
        for r, (host, path) in enumerate(parts):
            for key in self.keys(host, path):
                rows.append(r)
                keys.append(key)
        rules: list[str | None] = [None] * len(parts)
        verdicts: list[str | None] = [None] * len(parts)
        if not keys or not len(self.digests):
            return rules, verdicts
        want = np.fromiter(map(xxhash.xxh64_intdigest, keys), "u8", len(keys))
        low = np.searchsorted(self.digests, want, "left")
        high = np.searchsorted(self.digests, want, "right")
        for j in np.flatnonzero(high > low):
            key = keys[j].encode()
            for i in range(low[j], high[j]):  # more than one entry only where digests collide
                if self.entry(i) == key:
                    r = rows[j]
                    if rules[r] is None or len(keys[j]) > len(rules[r]):
                        rules[r], verdicts[r] = keys[j], "block" if self.blocks[i] else "allow"
        return rules, verdicts


def url_filter(pages: DataFrame, rules: Iterable[tuple[str, str]] = RULES, id_col: str = "page_id",
               url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, host, path, rule, verdict.

    A rule ``host/path`` fits its host and all subdomains when the URL's path starts with the
    rule's; the longest fitting rule wins. Without one, ``rule`` is NULL and the verdict is
    ``default``. NULL or malformed URLs have an empty host and path and fit no rule. Repeated rows
    give repeated results; an empty table gives an empty one. Other columns are not read.
    """
    spark = pages.sparkSession
    name = f"url-index-{uuid.uuid4().hex}.bin"
    # the driver's upload: Spark's file server hands it to each executor's own SparkFiles folder, also
    # to executors that start later, so it stays until the driver ends
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="url-index-")), name)
    with open(path, "wb") as f:
        f.write(index_bytes(rules))
    spark.sparkContext.addFile(path)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = DigestIndex(SparkFiles.get(name))
        for batch in batches:
            parts = [split_url(u) for u in batch["_url"]]
            rule, verdict = index.probe(parts)
            yield pd.DataFrame({
                "_id": batch["_id"], "host": [h for h, _ in parts], "path": [p for _, p in parts],
                "rule": pd.Series(rule, dtype=object),
                "verdict": pd.Series([v or default for v in verdict], dtype=object)})

    id_type = pages.schema[id_col].dataType.simpleString()
    out = (pages.select(F.col(id_col).cast("string").alias("_id"), F.col(url_col).alias("_url"))
           .mapInPandas(judge, "_id string, host string, path string, rule string, verdict string"))
    return out.select(F.col("_id").cast(id_type).alias(id_col), "host", "path", "rule", "verdict")


def _case(value: str) -> str:
    """SQL CASE over the rules, the longest first."""
    arms = []
    for rule, verdict in sorted(RULES, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        fits = f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '/{path}')"
        arms.append(f"WHEN {fits} THEN '{rule if value == 'rule' else verdict}'")
    return "CASE " + " ".join(arms) + (" END" if value == "rule" else f" ELSE '{DEFAULT_VERDICT}' END")


ORACLE_SQL = rf"""
WITH after AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
               FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM after)
SELECT page_id, host, path, {_case('rule')} AS rule, {_case('verdict')} AS verdict FROM parts
"""
