"""Fact-to-dimension joins with Spark's size-checked broadcast and a policy for duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfarer.operators.clean import dedupe
from wayfarer.operators.reuse import broadcast_within

HINT_BYTES = 64 << 20  # largest side that gets a broadcast hint


class DuplicateKeyError(ValueError):
    pass


def unique_by_key(dim: DataFrame, keys: Sequence[str], policy: str = "first") -> DataFrame:
    """Make the dimension unique on ``keys``.

    ``first``: keep the smallest row by the remaining columns (deterministic);
    ``error``: raise if any key repeats (runs one job over the dimension);
    ``allow``: keep duplicates, each one then gets its own output rows.
    """
    keys = list(keys)
    if policy == "allow":
        return dim
    if policy == "first":
        return dedupe(dim, keys, order=[c for c in dim.columns if c not in keys])
    if policy == "error":
        dup = dim.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"dimension key {keys} repeats, e.g. {dup[0].asDict()}")
        return dim
    raise ValueError(f"unknown unique-key policy {policy!r}")


def join_dim(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", broadcast: str = "auto",
             unique_key: str = "first", hint_bytes: int = HINT_BYTES) -> DataFrame:
    """Join a fact table to a dimension on ``on``.

    ``broadcast``:
      * ``auto`` - no hint: Spark broadcasts when the planner's size estimate is under
        ``spark.sql.autoBroadcastJoinThreshold`` bytes and AQE switches to a broadcast at run time
        when the materialised side is that small; otherwise a sort-merge join whose hot keys AQE
        splits (``spark.sql.adaptive.skewJoin``). Nothing runs while the plan is built.
      * ``hint`` - a broadcast hint, whatever the threshold, while the optimiser expects ``dim`` to have at
        most ``hint_bytes``; beyond that as ``auto``. Nothing runs here either: a stored table's size is
        known from its files.
      * ``never`` - force a shuffle (sort-merge) join.
    """
    on = list(on)
    dim = unique_by_key(dim, on, unique_key)
    if broadcast == "never":
        dim = dim.hint("shuffle_merge")
    elif broadcast == "hint":
        dim = broadcast_within(dim, hint_bytes)
    elif broadcast != "auto":
        raise ValueError(f"unknown broadcast mode {broadcast!r}")
    return fact.join(dim, on=on, how=how)
