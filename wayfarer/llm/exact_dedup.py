"""Exact de-duplication by two-pass Bloom filtering.

Pass 1 counts, for each of two slots per text hash, how many rows fall into the slot and keeps
the slots with two rows or more as a packed bit table of bounded size. Pass 2 probes that table
(a broadcast join): a row with a slot of its own is certainly the only one with its text and goes
straight through; only the possibly repeated rows are shuffled by their full SHA-256. False
positives of the filter cost a little shuffle and never change a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import SPACE_RUN, stored, text_or_empty

BITS_PER_ROW = 16
MIN_BITS, MAX_BITS = 1 << 16, 1 << 26


def normalised(text: str | Column) -> Column:
    """Each run of ASCII white space becomes one space; NULL counts as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE_RUN, " ")


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two of about ``BITS_PER_ROW`` bits a row, at most ``max_bits``."""
    bits = MIN_BITS
    while bits < rows * BITS_PER_ROW and bits < max_bits:
        bits *= 2
    return bits


def _slots(bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64("_sha", F.lit(seed)), F.lit(bits)).cast("long") for seed in (11, 29)]


def repeated_slots(digests: DataFrame, bits: int) -> DataFrame:
    """(_word, _bits): the slots hit by two rows or more, 64 of them packed in a long. Slot counts
    are pre-aggregated before they are shuffled, so a hot text costs one row for each task."""
    slot = F.explode(F.array_distinct(F.array(*_slots(bits)))).alias("_slot")
    return (digests.select(slot).groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
            .where("_n > 1")
            .groupBy(F.shiftright("_slot", 6).alias("_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_slot & 63 AS INT))")).alias("_bits")))


def possibly_repeated(digests: DataFrame, bits: int) -> DataFrame:
    """``digests`` with ``_maybe``: both slots of the row are in the filter. The broadcast table has
    at most ``bits / 64`` rows (1 M rows, 16 MB, at ``MAX_BITS``), whatever the size of the corpus."""
    words = repeated_slots(digests, bits)
    out = digests
    hits = []
    for i, slot in enumerate(_slots(bits)):
        side = words.select(F.col("_word").alias(f"_w{i}"), F.col("_bits").alias(f"_b{i}"))
        out = (out.withColumn(f"_s{i}", slot)
               .join(F.broadcast(side), F.shiftright(F.col(f"_s{i}"), 6) == F.col(f"_w{i}"), "left"))
        hits.append(F.expr(f"coalesce(shiftright(_b{i}, CAST(_s{i} & 63 AS INT)) & 1L, 0L) = 1L"))
    return out.withColumn("_maybe", hits[0] & hits[1])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white-space runs become one space (NULL equals empty).
    Of equal texts the smallest id stays. Rows that repeat an id stay or go together; a NULL id
    stays only when its whole group has no id. An empty table gives an empty result. Other
    columns of ``docs`` are not read.

    ``max_bits`` bounds the broadcast filter. Beyond about ``max_bits / 16`` rows the filter lets
    more unique rows into the shuffle (8-byte id and 32-byte digest each); results stay exact.
    """
    digests = stored(docs.select(F.col(id_col).alias("_id"),
                                 F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("_sha")),
                     "exact-digests")
    flagged = possibly_repeated(digests, filter_bits(digests.count(), max_bits))
    alone = flagged.where(~F.col("_maybe")).select(
        "_id", "_sha", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    shared = flagged.where("_maybe").select("_id", "_sha")
    groups = shared.groupBy("_sha").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    found = shared.join(groups, "_sha").select("_id", "_sha", "keep_id", "group_size")
    return alone.unionByName(found).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


# DuckDB: the contract's result computed in one plain window.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
