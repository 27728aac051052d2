"""Map column expressions: in-row argmax and a canonical text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_keys(map_col: str | Column) -> Column:
    """All keys whose value equals the map's maximum, sorted ascending.

    NULL for a NULL or empty map. Evaluated inside the row, so it needs no explode, window
    or shuffle (the rank-1 keys of ``dense_rank`` over the exploded map, collected).
    """
    m = _col(map_col)
    best = F.array_max(F.map_values(m))
    keys = F.array_sort(F.map_keys(F.map_filter(m, lambda k, v: v == best)))
    return F.when(F.size(m) > 0, keys)


def map_text(map_col: str | Column, entry_sep: str = "|", kv_sep: str = "=") -> Column:
    """Canonical ``k=v|k=v`` text, entries sorted by key; '' for an empty map, NULL for NULL."""
    entries = F.array_sort(F.map_entries(_col(map_col)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit(kv_sep), e["value"].cast("string"))),
        entry_sep,
    )
