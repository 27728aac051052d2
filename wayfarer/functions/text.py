"""String column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_META = set("\\.^$|?*+()[]{}")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_regex(text: str) -> str:
    """Escape regex metacharacters so ``text`` matches literally (Java regex and RE2 agree on this)."""
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in text)


def blank_to_null(c: str | Column) -> Column:
    """NULL when the value is empty after trimming spaces; otherwise the *untrimmed* original.

    Only the space character is trimmed (Spark ``trim``), so a lone tab survives.
    """
    c = _col(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def split_keep_empty(c: str | Column, sep: str = ";") -> Column:
    """Split on a literal separator keeping empty and trailing empty elements."""
    pattern = sep if len(sep) == 1 and sep not in _REGEX_META else literal_regex(sep)
    return F.split(_col(c), pattern, -1)


def composite_id(sep: str, *cols: str | Column) -> Column:
    """NULL-skipping join of several columns (``concat_ws``)."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def period_label(year: str | Column, period: str | Column, marker: str = "Q") -> Column:
    """``2021`` + ``Q`` + ``3`` -> ``2021Q3``; NULL if either part is NULL."""
    return F.concat(_col(year).cast("string"), F.lit(marker), _col(period).cast("string"))


def not_blank(c: str | Column) -> Column:
    """True when the value has something other than spaces (NULL stays NULL -> filtered out)."""
    return F.trim(_col(c)) != ""
