"""The pipeline's stages on the smallest tables, each against what its operator says of its input."""

import pytest

import corpus_pipeline as C
from tests.conftest import SF_SMALL
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_token_binary import want as token_rows
from wayfarer.llm.common import stored


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(stored(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality", "near_copies", "decontaminate", "mix", "tokens"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_rejects_some_and_keeps_good_labels(spark, stages):
    kept = set(ids(stages[1]))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_one_of_each_group(stages):
    assert ids(stages[2]) == sorted(i for i, n, c in components(pairs(stages[1])) if n == 0 or i == c)


def test_no_benchmark_passage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert ids(stages[3]) == sorted(i for i, t in pairs(stages[2]) if not contamination(t, items)[-1])


def test_mixture_is_a_part(stages):
    assert set(ids(stages[4])) < set(ids(stages[3]))


def test_tokens_of_what_is_left(stages):
    assert [tuple(r) for r in stages[5].orderBy("start").collect()] == token_rows(sorted(pairs(stages[4])))


def test_run(spark, stages):
    assert sorted(map(tuple, C.run(spark, SF_SMALL).collect())) == sorted(map(tuple, stages[5].collect()))


def test_registered():
    import __spark_entry__ as E

    assert "pipeline" in E.queries() and (C.ORACLE_SQL is None) == ("pipeline" not in E.oracle_sql())
