import numpy as np
import pytest

from tests.llm.conftest import path
from wayfarer.llm import quality_classifier as Q


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(path("documents", "sf0.1")), spark.read.parquet(path("labels", "sf0.1"))


def test_held_out_accuracy(spark, tables):
    """Trained on the labels of even ids, judged on those of odd ids."""
    docs, labels = tables
    model = Q.train(docs, labels.where("doc_id % 2 = 0"))
    rows = Q.score(docs.where("doc_id % 2 = 1"), model).join(labels, "doc_id").select("quality", "keep").collect()
    good = [r.keep for r in rows if r.quality == 1]
    bad = [r.keep for r in rows if r.quality == 0]
    assert len(good) > 500 and len(bad) > 100
    assert sum(good) / len(good) > 0.985
    assert sum(bad) / len(bad) < 0.1


def test_views_teach_each_other():
    """Few labels; each view sees its own noisy copy of the class. The exchange helps or does no harm,
    and both views have handed documents over."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 3000)
    content = (y * 2 - 1)[:, None] * 1.6 + rng.normal(size=(3000, 6)) * [1, 2, 2, 2, 2, 2]
    meta = (y * 2 - 1)[:, None] * 1.2 + rng.normal(size=(3000, 4)) * [1, 2, 2, 2]
    held = np.arange(60) % 4 == 0
    args = (content[:60], meta[:60], y[:60], held, content[60:1500], meta[60:1500])
    alone, both = Q.co_train(*args, rounds=0), Q.co_train(*args)
    assert min(both.exchanged) > 20 and alone.exchanged == (0, 0)

    def right(model):
        return ((model.scores(content[1500:], meta[1500:])[2] > 0.5) == y[1500:]).mean()

    assert right(both) > 0.9 and right(both) >= right(alone) - 0.01


def test_same_result_again(tables):
    docs, labels = tables
    one, two = (Q.train(d, labels) for d in (docs, docs.repartition(7)))
    assert np.allclose(one.combined.weights, two.combined.weights)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, keep string, _text int, score int")


def test_special_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x" * 100_000, "en", "s", 5), (None, "a b", "en", "s", 3),
            (4, "퟿ \x00 😀", "q", "s", 3), (5, "same", "en", "s", 4), (5, "same", "en", "s", 4)]
    docs = frame(spark, [(*r, "k", 1, 2) for r in rows])
    labels = spark.createDataFrame([(2, 0, 1), (5, 1, 0), (5, 0, 0), (None, 1, 0), (3, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    found = Q.score(docs, Q.train(docs, labels), carry=("text",)).collect()
    assert len(found) == 7
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 5}) == 1
    assert {r.text for r in found if r.doc_id == 1} == {None}


def test_without_labels_everything_stays(spark):
    docs = frame(spark, [(1, "a", "en", "s", 1, "k", 1, 2)])
    for labels in ([], [(1, 1, 0)]):
        t = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        r = Q.classify(docs, t).collect()[0]
        assert (r.score, r.keep) == (1.0, True)
    assert Q.classify(frame(spark, []), t).collect() == []
