"""Registered queries of the corpus operators: each reads its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm import (
    decontaminate,
    exact_dedup,
    license_scan,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    pii_surrogates,
    quality_classifier,
    secret_scan,
    token_binary,
    url_filter,
    whitening,
)
from wayfarer.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.pseudonymise(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_binary(read(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(read(spark, sf_dir, "pages"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.periodic_runs(read(spark, sf_dir, "documents"), periodic_runs.said_again))


def queries() -> dict[str, Query]:
    found = (op1_exact_dedup, op2_license_scan, op3_pii_surrogates, op4_mixing, op5_token_binary, op6_quality_classifier,
             op7_ngram_join, op8_secret_scan, op9_decontaminate, op10_url_filter, op11_packing, op12_embedding_whitening,
             op13_periodic_runs)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.ORACLE_SQL, "op8_secret_scan": secret_scan.ORACLE_SQL,
            "op9_decontaminate": decontaminate.ORACLE_SQL, "op10_url_filter": url_filter.ORACLE_SQL}
