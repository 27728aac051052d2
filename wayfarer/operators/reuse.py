"""Scoped reuse: a DataFrame kept in the executors while a block runs, released in any case."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = StorageLevel(False, False, False, False)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df``, computed at most once while the block runs: its first action keeps the rows (in memory, what
    does not fit on the executors' disks), later ones read them. They are released when the block ends,
    also by an exception. Blocks that are lost with an executor are computed again from the lineage.

    A ``df`` that is persisted already is left as it is, here and at the end: whoever persisted it
    releases it, so blocks can be nested."""
    if df.storageLevel != NONE:
        yield df
        return
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def expected_bytes(df: DataFrame) -> int | None:
    """The size that Spark's optimiser expects of ``df``; of persisted rows that have been computed, the size
    they have. None where the optimiser can't be asked (Spark Connect)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def broadcast_within(df: DataFrame, max_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint when its expected size is at most ``max_bytes``, else as it is: Spark then
    decides by its own threshold, or shuffles."""
    size = expected_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df
