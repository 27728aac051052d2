"""Period-over-period growth and the "rising" flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfarer.functions.dates import period_index


def period_over_period(df: DataFrame, entity: Sequence[str], measure: str,
                       periods: Sequence[str] = ("travel_year", "travel_quarter"), periods_per_year: int = 4,
                       threshold: float = 0.3, gap: str = "bridge", flags: Sequence[str] = ("none", "yes", "no"),
                       rate_col: str = "visit_cnt_growth_rate", flag_col: str = "is_hot_rising") -> DataFrame:
    """Add growth rate and rising flag per entity.

    ``prev`` is the measure of the previous row of the entity ordered by period:
      * ``bridge`` - the last *observed* period (a skipped quarter is bridged);
      * ``strict`` - the calendar-previous period only: NULL when the entity has no earlier
        row at all, 0 when the earlier row is not adjacent.
    rate = round((cur - prev) / prev, 4) when prev > 0, else 0.
    flag = flags[0] when prev is NULL, flags[1] when the *rounded* rate > threshold, else flags[2].

    The window holds one row per entity and period (the input is already aggregated), so a
    window partition is bounded by the number of periods, whatever the data volume.
    """
    w = Window.partitionBy(*entity).orderBy(*periods)
    cur = F.col(measure)
    prev = F.lag(cur, 1).over(w)
    if gap == "strict":
        idx = period_index(periods[0], periods[1], periods_per_year)
        prev_idx = F.lag(idx, 1).over(w)
        prev = F.when(prev_idx.isNull(), F.lit(None)).when(prev_idx == idx - 1, prev).otherwise(F.lit(0))
    elif gap != "bridge":
        raise ValueError(f"unknown gap mode {gap!r}")
    df = df.withColumn("_prev", prev)
    p = F.col("_prev")
    rate = F.when(p.isNotNull() & (p > 0), F.round((cur - p) / p, 4)).otherwise(F.lit(0.0))
    df = df.withColumn(rate_col, rate)
    flag = (F.when(p.isNull(), flags[0]).when(F.col(rate_col) > threshold, flags[1]).otherwise(flags[2]))
    return df.withColumn(flag_col, flag).drop("_prev")
