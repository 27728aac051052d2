"""Quality classifier by co-training of two views.

The content view sees what a text says (characters, words, repetition), the metadata view what is
known of the page without reading it (source, language, size, layout). Both start from the labelled
sample; in each round each view labels the unlabelled documents it is sure of, and the other view
learns from them. The views are then calibrated and combined on held-out labels. Training is done
on a bounded, documented sample of feature rows; features and scores of all documents are computed
where the documents are.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000  # labelled documents used for training, chosen by the hash of their id
MAX_UNLABELLED = 20_000  # about as many unlabelled documents exchanged between the views
ROUNDS = 4
SURE = 0.98  # probability from which a view hands a document to the other one
REJECT_BELOW = 0.2  # probability of good quality under which a document goes

SOURCE_SLOTS, LANG_SLOTS = 64, 16
CONTENT = ("upper", "digit", "mark", "odd_mark", "bang", "other", "words_log", "word_length", "distinct_words", "top_word",
           "marked_words", "upper_words", "distinct_lines", "distinct_pairs", "short_words", "empty")
LAYOUT = ("chars_log", "lines_log", "line_length", "short_lines", "blank_lines", "bytes_per_char", "size_differs")

_CLASS = np.zeros(256, "i1")
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
for _c in b"!#$%&*+/<=>@^_`|~\\":
    _CLASS[_c] = 5
for _c in b"\"'(),-.:;?[]{}":
    _CLASS[_c] = 4


def content_features(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    count = np.bincount(_CLASS[np.frombuffer(raw, "u1")], minlength=7) if raw else np.zeros(7)
    words = text.split()
    m = max(1, len(words))
    lower = [w.lower() for w in words]
    distinct = set(lower)
    lines = [x for x in text.split("\n") if x.strip()]
    top = max(Counter(lower).values(), default=0)
    return [
        count[1] / max(1, count[1] + count[2]), count[3] / n, count[4] / n, count[5] / n, raw.count(b"!") / n, count[6] / n,
        float(np.log1p(len(words))), sum(map(len, words)) / m, len(distinct) / m, top / m,
        sum(not w[-1].isalnum() and w[-1] not in ".,;:?)\"'" for w in words) / m, sum(w.isupper() for w in words) / m,
        len(set(lines)) / max(1, len(lines)), len(set(zip(lower, lower[1:], strict=False))) / max(1, len(lower) - 1),
        sum(len(w) < 4 for w in words) / m, float(not words)]


def layout_features(text: str, n_chars: float | None) -> list[float]:
    lines = text.split("\n")
    lengths = np.array([len(x) for x in lines])
    return [float(np.log1p(len(text))), float(np.log1p(len(lines))), float(np.log1p(lengths.mean())), float((lengths < 20).mean()),
            float((lengths == 0).mean()), len(text.encode("utf-8", "replace")) / max(1, len(text)),
            float(n_chars is None or n_chars != n_chars or n_chars != len(text))]


def slot(value: str | None, slots: int) -> int:
    return zlib.crc32(str(value or "").encode("utf-8", "replace")) % slots


def feature_rows(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch (_text, _source, _lang, _chars) the content and layout features, and the slots of
    source and language."""
    texts = ["" if t is None or t != t else t for t in batch["_text"]]
    dense = [content_features(t) + layout_features(t, c) for t, c in zip(texts, batch["_chars"], strict=True)]
    slots = [(slot(s, SOURCE_SLOTS), slot(g, LANG_SLOTS)) for s, g in zip(batch["_source"], batch["_lang"], strict=True)]
    return (np.array(dense, "f4").reshape(len(texts), len(CONTENT) + len(LAYOUT)),
            np.array(slots, "i4").reshape(len(texts), 2))


def views(dense: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two views' features: content; layout with one column for each slot."""
    content, layout = dense[:, :len(CONTENT)].astype("f8"), dense[:, len(CONTENT):].astype("f8")
    return content, np.hstack([layout, np.eye(SOURCE_SLOTS)[slots[:, 0]], np.eye(LANG_SLOTS)[slots[:, 1]]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, by Newton's method."""

    ridge: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        a = self._design(x)
        w = np.zeros(a.shape[1])
        penalty = np.full(a.shape[1], self.ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = sigmoid(a @ w)
            step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty), a.T @ (p - y) + penalty * w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._design(x) @ self.weights, -30, 30)


@dataclass
class CoTrained:
    """Two views, each with its calibration, and their combination; ``prior`` alone when the labels
    hold no more than one class."""

    prior: float
    views: tuple[Logistic, Logistic] | None = None
    calibration: tuple[Logistic, Logistic] | None = None
    combined: Logistic | None = None
    exchanged: tuple[int, int] = (0, 0)

    def scores(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: by content, by metadata, by both."""
        if self.views is None:
            one = np.full(len(content), self.prior)
            return one, one, one
        logits = [v.logit(x)[:, None] for v, x in zip(self.views, (content, meta), strict=True)]
        each = [c.logit(z) for c, z in zip(self.calibration, logits, strict=True)]
        return sigmoid(each[0]), sigmoid(each[1]), sigmoid(self.combined.logit(np.column_stack(each)))


def co_train(content: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, more_content: np.ndarray,
             more_meta: np.ndarray, rounds: int = ROUNDS, sure: float = SURE) -> CoTrained:
    """``held`` marks labelled rows kept for calibration; ``more_*`` are the unlabelled rows."""
    if not len(y) or y.min() == y.max() or any(len(np.unique(y[k])) < 2 for k in (held, ~held)):
        return CoTrained(prior=float(y.mean()) if len(y) else 1.0)
    data, more = (content, meta), (more_content, more_meta)
    pools = [(x[~held], y[~held].astype("f8")) for x in data]
    given = [np.zeros(len(more_content), bool), np.zeros(len(more_content), bool)]  # to each view
    for turn in range(rounds + 1):
        views = [Logistic().fit(x, t) for x, t in pools]
        calibration = [Logistic(ridge=1e-3).fit(v.logit(x[held])[:, None], y[held]) for v, x in zip(views, data, strict=True)]
        if turn == rounds or not len(more_content):
            break
        for giver, taker in ((0, 1), (1, 0)):
            p = sigmoid(calibration[giver].logit(views[giver].logit(more[giver])[:, None]))
            new = ((p >= sure) | (p <= 1 - sure)) & ~given[taker]
            given[taker] |= new
            pools[taker] = (np.vstack([pools[taker][0], more[taker][new]]), np.append(pools[taker][1], (p[new] > 0.5).astype("f8")))
    each = np.column_stack([c.logit(v.logit(x[held])[:, None]) for c, v, x in zip(calibration, views, data, strict=True)])
    return CoTrained(float(y.mean()), tuple(views), tuple(calibration), Logistic(ridge=0.05).fit(each, y[held]),
                     (int(given[0].sum()), int(given[1].sum())))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, chars_col: str):
    return [F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(source_col).cast("string").alias("_source"),
            F.col(lang_col).cast("string").alias("_lang"), F.col(chars_col).cast("double").alias("_chars")]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars", quality_col: str = "quality") -> CoTrained:
    """Fit on at most ``MAX_LABELLED`` labelled and about ``MAX_UNLABELLED`` other documents. A document
    with several labels counts as bad when one of them says so. Labels without an id, a value or a document
    are passed over. Only the sample's features reach the driver."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull()).groupBy(
        F.col(id_col).alias("_lid")).agg(F.min(quality_col).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("_lid"), "_lid").limit(MAX_LABELLED)
    n = docs.count()
    share = min(1.0, MAX_UNLABELLED / max(1, n))
    rows = docs.select(*_rows(docs, id_col, text_col, source_col, lang_col, chars_col))
    # the broadcast side has at most MAX_LABELLED rows of 12 bytes
    rows = rows.join(F.broadcast(known), F.col("_id") == F.col("_lid"), "left")
    draw = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000)
    rows = rows.where(F.col("_y").isNotNull() | draw)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dense, slots = feature_rows(batch)
            yield pd.DataFrame({"_id": batch["_id"].astype("string"), "y": batch["_y"].astype("Int32"),
                                "dense": [x.tobytes() for x in dense], "source": slots[:, 0], "lang": slots[:, 1]})

    got = rows.withColumn("_id", F.col("_id").cast("string")).mapInPandas(
        features, "_id string, y int, dense binary, source int, lang int")
    # about a hundred bytes a row; sorted, as the fit must not depend on the order of tasks
    got = got.toPandas().sort_values(["_id", "dense"], kind="stable")
    dense = np.frombuffer(b"".join(got["dense"]), "f4").reshape(len(got), len(CONTENT) + len(LAYOUT))
    content, meta = views(dense, got[["source", "lang"]].to_numpy("i4").reshape(len(got), 2))
    has = got["y"].notna().to_numpy(bool)
    y = got["y"][has].to_numpy("i8")
    held = np.zeros(len(y), bool)
    for k in (0, 1):  # every fourth of either class
        held[np.flatnonzero(y == k)[::4]] = True
    return co_train(content[has], meta[has], y, held, content[~has], meta[~has])


def score(docs: DataFrame, model: CoTrained, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          lang_col: str = "lang", chars_col: str = "n_chars", reject_below: float = REJECT_BELOW,
          carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, content_score, metadata_score, score (probabilities of good
    quality), keep. ``carry`` names columns of ``docs`` that are passed on.

    NULL text counts as empty and NULL in a metadata column as a value of its own. Each row is scored by
    itself; repeated rows get equal scores. Without labels of both classes every score is the share of
    good labels (1 without labels). An empty table gives an empty result.
    """
    kept = [F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)]
    rows = docs.select(*_rows(docs, id_col, text_col, source_col, lang_col, chars_col), *kept)
    names = ["_id", *[f"_carry{i}" for i in range(len(carry))]]

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            scores = model.scores(*views(*feature_rows(batch.select(["_text", "_source", "_lang", "_chars"]).to_pandas())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(s, pa.float64()) for s in scores],
                names=[*names, "content_score", "metadata_score", "score"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names) + ", content_score double, metadata_score double, score double"
    out = rows.mapInArrow(judge, schema)
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)],
                      *[F.round(c, 6).alias(c) for c in ("content_score", "metadata_score", "score")],
                      (F.col("score") >= reject_below).alias("keep"))


def classify(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """``train`` on ``labels``, then ``score`` of all ``docs``."""
    return score(docs, train(docs, labels, **columns), **columns)
