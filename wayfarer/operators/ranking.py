"""Per-group rankings: top-N without ties and argmax sets with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number`` within each group by ``order`` (which must end in a unique tie-breaker)
    and keep ranks ``<= n``.

    Spark plans the filter as ``WindowGroupLimit`` (partial before the shuffle, final after),
    so at most ``n`` rows per group and input partition cross the network even when the
    group key has only a handful of values.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def argmax_set(df: DataFrame, keys: Sequence[str], item: str, measure: str, out: str) -> DataFrame:
    """Per ``keys``, the sorted array of all ``item`` values tied at the maximum ``measure``.

    Long-table form (dense_rank = 1, then collect). For map columns prefer
    ``wayfarer.functions.top_keys``, which needs no shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc())
    best = df.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") == 1)
    return best.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias(out))
