"""Row cleaning operators (null keys, blanks, defaults, dates, de-duplication, explode)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.functions.dates import REFERENCE_DATE_FORMATS, parse_date_multi
from wayfarer.functions.text import blank_to_null, not_blank, split_keep_empty


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows where any key is NULL. Blank strings are *not* NULL and survive.

    Same rows as ``na.drop(how="any", subset=keys)``, written as ``IS NOT NULL`` conjuncts so
    they reach the Parquet scan as pushed filters (row groups without values are skipped).
    """
    keys = list(keys)
    if not keys:
        return df
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def blanks_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace space-only strings by NULL in the given columns."""
    return df.withColumns({c: blank_to_null(c) for c in cols})


def fill_default(df: DataFrame, value: str, cols: Sequence[str]) -> DataFrame:
    """NULL -> ``value`` in the given string columns."""
    return df.na.fill(value, subset=list(cols))


def with_parsed_date(df: DataFrame, src: str, out: str = "travel_date",
                     formats: Sequence[str] = REFERENCE_DATE_FORMATS,
                     year_col: str | None = "travel_year", month_col: str | None = "travel_month") -> DataFrame:
    """Parse ``src`` with the first matching format; add year / month (INT) of the result."""
    cols = {out: parse_date_multi(src, formats)}
    df = df.withColumns(cols)
    extra = {}
    if year_col:
        extra[year_col] = F.year(out)
    if month_col:
        extra[month_col] = F.month(out)
    return df.withColumns(extra) if extra else df


def year_range(df: DataFrame, year_col: str, lo: int, hi: int) -> DataFrame:
    """Keep ``lo <= year < hi``; NULL years (unparsed dates) fall out by three-valued logic."""
    y = F.col(year_col)
    return df.filter((y >= lo) & (y < hi))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), hash_lead: bool = True) -> DataFrame:
    """One row per key combination; the survivor is the smallest by ``order`` (NULLs last),
    remaining ties broken by the other columns, so the result never depends on input order.

    Planned as ``groupBy(keys).agg(min(struct))``: partial aggregation runs before the shuffle,
    so a group of copies holding a large share of all rows is collapsed map-side and never
    lands whole in one task. The aggregate is sort-based (its buffer holds strings); a 64-bit
    hash of the keys leads the grouping so the sorts compare one long instead of the (often
    long) key strings. The real keys stay in the grouping, so collisions cannot merge groups.
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    others = [c for c in df.columns if c not in keys and c not in order]
    parts = []
    for i, c in enumerate(order):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"o{i}")]
    parts += [F.col(c).alias(f"r{i}") for i, c in enumerate(others)]
    if not parts:
        return df.select(*keys).distinct()
    lead = [F.xxhash64(*keys).alias("_h")] if hash_lead else []
    best = df.groupBy(*lead, *keys).agg(F.min(F.struct(*parts)).alias("_best"))
    back = {c: F.col(f"_best.o{i}") for i, c in enumerate(order)}
    back.update({c: F.col(f"_best.r{i}") for i, c in enumerate(others)})
    return best.select(*[F.col(c) if c in keys else back[c].alias(c) for c in df.columns])


def explode_sequence(df: DataFrame, src: str, out: str, sep: str = ";", drop_src: bool = True) -> DataFrame:
    """One row per element of a separated list; blank elements dropped, others kept untrimmed,
    repeated elements kept."""
    df = df.withColumn(out, F.explode(split_keep_empty(src, sep))).filter(not_blank(out))
    return df.drop(src) if drop_src and src != out else df
