"""A training corpus from ``documents``, stage by stage.

Each stage is one operator of ``wayfarer.llm`` on what its predecessor kept; ``run`` writes every
stage's rows to the shared folder and reads them back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm import decontaminate, mixing, ngram_join, quality_classifier, token_binary
from wayfarer.llm.common import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    labels = read(spark, sf_dir, "labels")
    model = quality_classifier.train(docs, labels)
    others = tuple(c for c in docs.columns if c != "doc_id")
    return quality_classifier.score(docs, model, carry=others).where("keep").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.drop_near_copies(docs).select(*docs.columns)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their targets."""
    return mixing.sample(docs).select(*docs.columns)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed token ids in the shared folder; returns where each document's ids are."""
    return token_binary.token_binary(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", clean_of_benchmark),
    ("mix", mixture),
    ("tokens", token_blocks),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained classifier, a tokenizer and the join are not SQL; tests/llm checks the stages.
ORACLE_SQL = None
