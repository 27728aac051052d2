"""Date column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The departure-date layouts the source data uses, tried in this order.
REFERENCE_DATE_FORMATS = ("yyyy/M/d", "yyyy-MM-dd", "yyyyMMdd")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_literals(fmt: str) -> list[str]:
    """Characters that every text matching a datetime pattern contains: separators and quoted text.

    None are named for a pattern with an optional section (``[...]``): its literals need not occur."""
    if "[" in fmt:
        return []
    out, quoted, i = [], False, 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            if i + 1 < len(fmt) and fmt[i + 1] == "'":
                out.append("'")
                i += 2
                continue
            quoted = not quoted
        elif quoted or not ch.isalpha():
            out.append(ch)
        i += 1
    return sorted(set(out))


def parse_date_multi(c: str | Column, formats: Sequence[str] = REFERENCE_DATE_FORMATS) -> Column:
    """First format that parses wins; unparseable text gives NULL.

    ``try_to_date`` keeps this safe under ANSI mode, where ``to_date`` raises on the first
    value that does not match one of the formats. A format is only attempted when the text
    contains all of its literal characters (a necessary condition for a match, so results
    are unchanged; formats with optional sections are always attempted): a failed parse is
    expensive, and this skips nearly all of them.
    """
    c = _col(c)
    parsed = []
    for fmt in formats:
        attempt = F.try_to_date(c, fmt)
        lits = format_literals(fmt)
        if lits:
            guard = c.contains(lits[0])
            for ch in lits[1:]:
                guard = guard & c.contains(ch)
            attempt = F.when(guard, attempt)
        parsed.append(attempt)
    return F.coalesce(*parsed)


def quarter_of_month(month: str | Column) -> Column:
    """Quarter 1..4 from a month 1..12 (``ceil(m / 3)``), as INT."""
    return F.ceil(_col(month) / F.lit(3)).cast("int")


def days_since(reference_date: str, c: str | Column) -> Column:
    """Whole days from ``c`` up to the reference date (positive when ``c`` is earlier)."""
    return F.datediff(F.to_date(F.lit(reference_date)), _col(c))


def period_index(year: str | Column, period: str | Column, periods_per_year: int) -> Column:
    """Consecutive integer for (year, period) so calendar neighbours differ by exactly 1."""
    return _col(year).cast("bigint") * periods_per_year + (_col(period).cast("bigint") - 1)
