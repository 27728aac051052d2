"""Staged replacement of tables: write the new version beside the old one, then switch.

A table is a folder of versions and a small pointer file that names the current one. A write that fails
leaves the pointer and the old version alone; a reader follows the pointer once, when it builds its plan,
and goes on with that version while a newer one appears beside it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfarer.sources.files import delete, folders, read_text, write_text
from wayfarer.sources.tables import read_table, write_layer

POINTER = "_current.json"


def current_version(spark: SparkSession, table: str) -> str | None:
    """The folder of the table's current version; None before the first one."""
    text = read_text(spark, f"{table}/{POINTER}")
    return f"{table}/{json.loads(text)['version']}" if text else None


def replace_staged(df: DataFrame, name: str, table: str, keep: int = 1,
                   check: Callable[[DataFrame], None] | None = None, **options) -> str:
    """Replace the whole of layer table ``name`` under ``table``; returns the new version's folder.

    The rows are written in full, and ``check`` (if given) has read them back without raising, before the
    pointer is switched. ``df`` may read the table itself. The ``keep`` versions before the new one stay for
    readers that are still at work; older ones, and what failed writes left, are deleted after the switch."""
    spark, table = df.sparkSession, table.rstrip("/")
    before = current_version(spark, table)
    version = f"v-{uuid.uuid4().hex[:12]}"
    write_layer(df, name, f"{table}/{version}", **options)
    if check is not None:
        check(read_table(spark, f"{table}/{version}"))
    known = json.loads(read_text(spark, f"{table}/{POINTER}"))["kept"] if before else []
    kept = [version, *known][:keep + 1]
    write_text(spark, f"{table}/{POINTER}", json.dumps({"version": version, "kept": kept}))
    for folder in folders(spark, table):
        if folder.startswith("v-") and folder not in kept:
            delete(spark, f"{table}/{folder}")
    return f"{table}/{version}"


def read_staged(spark: SparkSession, table: str, **options) -> DataFrame:
    """The current version of a staged table."""
    at = current_version(spark, table.rstrip("/"))
    if at is None:
        raise FileNotFoundError(f"{table} has no version yet")
    return read_table(spark, at, **options)


def switch_location(spark: SparkSession, table: str, name: str, df: DataFrame, place: str) -> str:
    """Replace the rows of an unpartitioned external catalog table: write a folder of its own under ``place``,
    then set the table's location to it, one change in the catalog. Returns the new folder."""
    at = f"{place.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    write_layer(df, name, at)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{at}'")
    spark.catalog.refreshTable(table)
    return at
