"""Data-quality profiles computed as ordinary aggregates (no driver-side loops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, NULLs, space-only values, min and max of the column's own type, as text.

    All columns are profiled in a single aggregate pass (partial per task, one tiny final
    merge) and the one wide row is then turned into rows with ``stack``.
    """
    aggs = []
    for i, c in enumerate(columns):
        s = F.col(c).cast("string")
        aggs += [F.count(F.lit(1)).alias(f"r{i}"), (F.count(F.lit(1)) - F.count(s)).alias(f"n{i}"),
                 F.count(F.when(F.trim(s) == "", F.lit(1))).alias(f"b{i}"),
                 F.min(F.col(c)).cast("string").alias(f"lo{i}"), F.max(F.col(c)).cast("string").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', r{i}, n{i}, b{i}, lo{i}, hi{i}" for i, c in enumerate(columns))
    return wide.selectExpr(
        f"stack({len(columns)}, {rows}) AS (column_name, row_cnt, null_cnt, blank_cnt, min_value, max_value)")


def parse_failures(df: DataFrame, src: str, parsed: str) -> DataFrame:
    """Distinct source texts that are present but did not parse, with their row counts."""
    return (df.filter(F.col(src).isNotNull() & F.col(parsed).isNull())
            .groupBy(src).agg(F.count(F.lit(1)).alias("row_cnt")))


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key combinations that repeat and the number of surplus rows they carry."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return counted.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"))


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """Rows for each value of a column, NULL included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_cnt"))


def conform_failures(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per text column that ``conform`` would parse into another type: values that are present,
    and of these the malformed ones it would turn into NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    parsed = [f for f in schema.fields if isinstance(have.get(f.name), StringType) and not isinstance(f.dataType, StringType)]
    if not parsed:
        return df.sparkSession.createDataFrame([], "column_name string, value_cnt bigint, failed_cnt bigint")
    aggs = []
    for i, f in enumerate(parsed):
        c = F.col(f.name)
        aggs += [F.count(c).alias(f"v{i}"), F.count(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(1))).alias(f"f{i}")]
    rows = ", ".join(f"'{f.name}', v{i}, f{i}" for i, f in enumerate(parsed))
    return df.agg(*aggs).selectExpr(f"stack({len(parsed)}, {rows}) AS (column_name, value_cnt, failed_cnt)")
