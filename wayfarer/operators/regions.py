"""Roll-ups over a place hierarchy: city, province, region and the whole, from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.operators.enrich import join_dim, unique_by_key

UNMAPPED = "unmapped"
LEVELS = ("region", "province", "city")  # from the widest
TOTAL = "total"


def region_dim(rows: DataFrame, policy: str = "first") -> DataFrame:
    """The mapping (city, province, region), trimmed, one row for each city: of a city that is mapped twice the
    smallest (``first``), or an error (``error``). Blank or missing provinces and regions are ``unmapped``."""
    def label(c: str) -> Column:
        return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(UNMAPPED)).alias(c)

    known = rows.select(F.trim("city").alias("city"), label("province"), label("region")).where(F.col("city") != "")
    return unique_by_key(known.distinct(), ["city"], policy)


def with_regions(df: DataFrame, dim: DataFrame, broadcast: str = "auto") -> DataFrame:
    """``df`` with the province and region of its ``city``; cities that are not in the mapping are kept, in the
    province and region ``unmapped``."""
    joined = join_dim(df, dim, ["city"], how="left", broadcast=broadcast, unique_key="allow")
    return joined.withColumns({c: F.coalesce(c, F.lit(UNMAPPED)) for c in ("province", "region")})


def hierarchy_rollup(df: DataFrame, period: Sequence[str], measures: Mapping[str, Column],
                     levels: Sequence[str] = LEVELS) -> DataFrame:
    """``measures`` for every level of the hierarchy ``levels`` (from the widest) in each period, by one
    aggregation with grouping sets: [period, level, *levels, *measures].

    ``level`` names the finest column that a row is grouped by, ``total`` for none; the finer columns are
    NULL. It is taken from the grouping id, so a NULL among the values is no subtotal."""
    period, levels = list(period), list(levels)
    sets = [[*period, *levels[:k]] for k in range(len(levels) + 1)]
    out = df.groupingSets([[F.col(c) for c in s] for s in sets], *period, *levels).agg(
        F.grouping_id().alias("_gid"), *[m.alias(name) for name, m in measures.items()])
    # a bit of the id is set for each column that a row is not grouped by; the finest level is the last bit
    level = F.lit(TOTAL)
    for k, name in enumerate(levels):
        finer = len(levels) - 1 - k
        level = F.when(F.col("_gid") == (1 << finer) - 1, name).otherwise(level)
    return out.select(*period, level.alias("level"), *levels, *measures)


def share_of_parent(df: DataFrame, period: Sequence[str], measure: str, out: str, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Adds each row's part of the ``measure`` of its parent, the row of the next wider level it belongs to
    (NULL for the total), rounded to four places."""
    depth = F.lit(0)
    for k, name in enumerate(levels):
        depth = F.when(F.col("level") == name, k + 1).otherwise(depth)
    # siblings share the columns wider than their own
    parent = [F.when(depth > k + 1, F.col(name)) for k, name in enumerate(levels)]
    whole = F.sum(measure).over(Window.partitionBy(*period, "level", *parent))
    return df.withColumn(out, F.when((depth > 0) & (whole > 0), F.round(F.col(measure) / whole, 4)))
