"""Helpers shared by the corpus operators: word patterns, null-safe text, stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.session import scratch_path

# The word and white-space classes of the result contracts.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NON_WORD_RUN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(c: str | Column) -> Column:
    """NULL text counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged (``lower`` would fold all of Unicode)."""
    return F.translate(c, UPPER, LOWER)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a lost executor
    costs at most the step that follows, and a table used twice is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
