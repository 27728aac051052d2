"""Mixing sources to target weights by iterative proportional fitting.

The corpus is summed once into cells (source, language, topic) with their tokens. Raking scales the
shares of the cells' tokens that are kept, none above one, to the targets of one marginal after the
other until all fit; the tables it works on have one row for each cell. A cell's share is the probability
with which its documents are kept, and a keyed hash of the document's id and text decides, so a repeated run or task
decides alike.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.llm.common import SPACE_RUN, stored, text_or_empty

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 12  # at least
MAX_ROUNDS = 1000
LEAST = 1e-5  # share of a cell's tokens that is kept at least, unless a target of its is 0
STALLED = 10  # rounds in which the distance from the targets must fall by a twentieth
TOLERANCE = 1e-4  # of the wanted tokens, that a value may be off its target
UNKNOWN = "?"  # stands for NULL in a dimension
LEAST_REST = 1e-9  # a smaller rest of the named shares is a rounding error

# Topics by the first pattern that a text contains; the rest are "prose".
TOPICS = (("legal", r"[Ll]icen[cs]e|[Cc]opyright"), ("contact", r"@|\+[0-9]{1,3} \("), ("data", r"[0-9]{6}"))

# Target shares: languages and topics named, the rest of a dimension's values share what is left
# in proportion to their tokens. Sources are levelled (None): each gets the same share.
TARGETS: dict[str, Mapping[str, float] | None] = {
    "source": None,
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {"legal": 0.02, "contact": 0.02, "data": 0.01},
}
KEEP_SHARE = 0.6  # of the corpus's tokens
SEED = "mix-1"


def tokens(text: Column) -> Column:
    """Words between white-space runs."""
    return F.size(F.array_remove(F.split(text, SPACE_RUN), "")).cast("long")


def topic(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def uniform(seed: str, *columns: Column) -> Column:
    """A number in [0, 1) from the MD5 of the seed and the columns; rows are drawn by their id and text, so
    that many rows of one id, or without one, do not stay or go together."""
    said = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit(UNKNOWN)) for c in columns])
    return F.conv(F.substring(F.md5(said), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def target_shares(cells: DataFrame, dimension: str, targets: Mapping[str, float] | None) -> DataFrame:
    """``cells`` with ``_t_<dimension>``, the target share of each row's value among the values that occur.
    Named shares that sum to more than one, or to less with no value left to take the rest, are scaled;
    if they leave nothing to values that are not named, these keep their shares of the tokens and the named
    ones share the others; if no value that occurs has a share, all keep their shares of the tokens."""
    whole = Window.partitionBy(F.lit(0))
    values = cells.groupBy(dimension).agg(F.sum("_tokens").cast("double").alias("_all"))
    if targets is None:
        share = F.lit(1.0)
    else:
        named = F.lit(None).cast("double")
        for v, s in targets.items():
            named = F.when(F.col(dimension) == v, F.lit(float(s))).otherwise(named)
        rest = max(0.0, 1.0 - sum(targets.values()))
        unnamed = F.sum(F.when(named.isNull(), F.col("_all"))).over(whole)
        if rest < LEAST_REST:
            others = F.sum(F.when(named.isNotNull(), F.col("_all"))).over(whole)
            share = F.coalesce(named, F.sum(named).over(whole) * F.col("_all") / others)
        else:
            share = F.coalesce(named, F.lit(rest) * F.col("_all") / unnamed)
    values = values.withColumn("_share", F.coalesce(share, F.lit(0.0)))
    total = F.sum("_share").over(whole)
    target = F.when(total > 0, F.col("_share") / total).otherwise(F.col("_all") / F.sum("_all").over(whole))
    return cells.join(values.select(dimension, target.alias(f"_t_{dimension}")), dimension)


def factors(size: np.ndarray, per_unit: np.ndarray, group: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each group the factor ``a`` with which its rows' ``size * min(1, a * per_unit)`` sum to ``wanted``, or
    with which all are whole. That sum is the least of its values with the rows of the largest ``per_unit``
    counted as whole, so the factor is the largest that one such choice gives."""
    order = np.lexsort((per_unit, group))
    n, part, of = size[order], (size * per_unit)[order], group[order]
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    rows = np.diff(np.append(starts, len(of)))

    def rising(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.cumsum(y) for y in np.split(x, starts[1:])])

    whole = np.repeat(np.add.reduceat(n, starts), rows) - rising(n)
    scaled = rising(part)
    tried = np.where(scaled > 0, (wanted[of] - whole) / np.where(scaled > 0, scaled, 1.0), 0.0)
    return np.clip(np.maximum.reduceat(tried, starts), 0.0, 1e100)


def rake(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], keep_share: float,
         rounds: int = ROUNDS) -> tuple[np.ndarray, list[np.ndarray], float]:
    """The share of each cell's ``tokens`` to keep, the tokens wanted of each value of each dimension, and the
    largest distance of a value's kept tokens from those, as a share of all that are wanted. ``codes`` number
    each dimension's values, ``shares`` are their target shares.

    A value gets its share of the wanted total, or all its tokens where these are fewer; the others
    share what it leaves. A cell's share is the product of one factor for each of its values, at most one. A step fits
    one dimension's factors, with the cells that the bound holds counted as they are, so what they cannot
    give comes from the other cells. At least ``rounds`` rounds, then until the distance is within
    ``TOLERANCE`` or no longer falls, at most ``MAX_ROUNDS``: targets that no choice under the bound meets
    together leave a gap, and would bring some cells to nothing but for ``LEAST``."""
    total = tokens.sum() * keep_share
    goals = []
    for code, share in zip(codes, shares, strict=True):
        there = np.bincount(code, weights=tokens, minlength=len(share))
        a = factors(there, share / there, np.zeros(len(share), "i8"), np.array([total]))
        goals.append(there * np.minimum(1.0, a * share / there))
    fit = [np.ones(len(share)) for share in shares]
    least = np.where(np.all([g[c] > 0 for g, c in zip(goals, codes, strict=True)], axis=0), LEAST, 0.0)
    off: list[float] = []
    while len(off) < max(rounds, 1) or (off[-1] > TOLERANCE and len(off) < MAX_ROUNDS and not (
            len(off) > STALLED and off[-1] > 0.95 * off[-1 - STALLED])):
        for d, code in enumerate(codes):
            others = np.prod([fit[k][c] for k, c in enumerate(codes) if k != d], axis=0)
            fit[d] = factors(tokens, others, code, goals[d])
        p = np.minimum(1.0, np.maximum(least, np.prod([f[c] for f, c in zip(fit, codes, strict=True)], axis=0)))
        kept = [np.bincount(c, weights=tokens * p) for c in codes]
        off.append(max(float(np.abs(k - g).max()) for k, g in zip(kept, goals, strict=True)) / max(total, 1e-300))
    return p, goals, off[-1]


def cell_probabilities(docs: DataFrame, targets=TARGETS, keep_share: float = KEEP_SHARE, rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, _tokens, _g_source, _g_lang, _g_topic, _p) of ``docs`` with the three dimensions
    and ``_n`` tokens: the tokens wanted of the cell's source, language and topic, and the share of the
    cell's that is kept, at most one. The cells, few whatever the corpus's size, are raked on the driver; a
    gap above ``TOLERANCE`` is told in a warning."""
    cells = stored(docs.groupBy(*DIMENSIONS).agg(F.sum("_n").alias("_tokens")).where("_tokens > 0"), "cells")
    for d in DIMENSIONS:
        cells = target_shares(cells, d, targets[d])
    found = cells.toArrow().to_pandas().sort_values(list(DIMENSIONS), ignore_index=True)
    size = found["_tokens"].to_numpy("f8")
    out = found[[*DIMENSIONS, "_tokens"]].copy()
    names = [f"_g_{d}" for d in DIMENSIONS]
    if len(found):
        codes, shares = [], []
        for d in DIMENSIONS:
            _, first, code = np.unique(found[d].to_numpy(str), return_index=True, return_inverse=True)
            codes.append(code)
            shares.append(found[f"_t_{d}"].to_numpy("f8")[first])
        p, goals, left = rake(size, codes, shares, keep_share, rounds)
        if left > TOLERANCE:
            warnings.warn(f"mixing: some value's tokens are {left:.6f} of the wanted total off its target", stacklevel=2)
        for name, goal, code in zip(names, goals, codes, strict=True):
            out[name] = goal[code]
        out["_p"] = np.round(p, 9)
    else:
        out = out.reindex(columns=[*out.columns, *names, "_p"])
    schema = "source string, lang string, topic string, _tokens long, _g_source double, _g_lang double, _g_topic double, _p double"
    rows = list(out.astype(object).itertuples(index=False, name=None))
    return stored(docs.sparkSession.createDataFrame(rows, schema), "raked")


def _facts(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(source_col).cast("string"), F.lit(UNKNOWN)).alias("source"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), topic(text).alias("topic"),
                       tokens(text).alias("_n"), F.md5(text).alias("_said"))


def mix(docs: DataFrame, targets=TARGETS, keep_share: float = KEEP_SHARE, seed: str = SEED, rounds: int = ROUNDS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, source, lang, topic, n_tokens, probability, kept.

    NULL in a dimension counts as the value ``?``; NULL text as empty. Documents without tokens are in no
    cell: probability 0, dropped. No document is repeated: a cell that would need more than its tokens keeps
    all of them, and a value of which there are fewer tokens than its target; the others share what these
    leave. Rows that repeat an id and a text are decided alike. An empty table gives an empty result. Other columns are not read.
    """
    facts = stored(_facts(docs, id_col, text_col, source_col, lang_col), "document-facts")
    cells = cell_probabilities(facts, targets, keep_share, rounds).select(*DIMENSIONS, "_p")
    out = facts.join(cells, list(DIMENSIONS), "left")
    probability = F.when(F.col("_n") > 0, F.coalesce("_p", F.lit(0.0))).otherwise(0.0)
    return out.select(F.col("_id").alias(id_col), *DIMENSIONS, F.col("_n").alias("n_tokens"), probability.alias("probability"),
                      (uniform(seed, F.col("_id"), F.col("_said")) < probability).alias("kept"))


def sample(docs: DataFrame, targets=TARGETS, keep_share: float = KEEP_SHARE, seed: str = SEED, rounds: int = ROUNDS,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, with all their columns. Only the cells' table is joined:
    a row's own text gives its cell and, with its id, the draw."""
    facts = _facts(docs, id_col, text_col, source_col, lang_col)
    cells = cell_probabilities(stored(facts, "document-facts"), targets, keep_share, rounds)
    text = text_or_empty(text_col)
    rows = docs.select(  # the row in one column: its own columns may have any names
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.md5(text).alias("said"),
        F.coalesce(F.col(source_col).cast("string"), F.lit(UNKNOWN)).alias("source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), topic(text).alias("topic"),
        text.rlike(r"[^\x20\x09-\x0D]").alias("some"))
    cells = cells.select(*DIMENSIONS, F.col("_p").alias("p"))
    return rows.where("some").join(cells, list(DIMENSIONS)).where(uniform(seed, F.col("id"), F.col("said")) < F.col("p")).select("row.*")
