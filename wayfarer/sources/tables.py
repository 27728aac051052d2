"""Layer tables on storage: declared-schema writes (optionally partitioned) and pruned reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfarer.schemas import TABLES, conform


def create_layer_databases(spark: SparkSession, layers: Sequence[str] = ("ods", "dwd", "dws", "ads")) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for each layer (catalog-backed deployments)."""
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def write_table(df: DataFrame, target: str, schema: StructType | None = None,
                partition_by: Sequence[str] = (), files_per_partition: int | None = None,
                overwrite: str = "static", as_table: bool = False, laid_out: bool = False,
                location: str | None = None) -> None:
    """Overwrite ``target`` (a path, or a catalog table when ``as_table``) with Parquet.

    ``schema`` is enforced first (select + cast by name), so the stored types are the declared
    ones. With ``partition_by`` the rows are first rebalanced on the partition columns: AQE
    coalesces small output partitions and splits skewed ones to the advisory size, so each
    table partition gets a few right-sized files instead of one file per task and period, and
    one huge period is still written by many tasks. ``files_per_partition`` instead spreads every
    table partition over exactly that many tasks (hash of all columns). ``laid_out`` says that
    ``df`` already has the layout to write. ``overwrite="dynamic"`` replaces only the partitions
    present in ``df``, of a path or of an existing catalog table. ``location`` is the folder of a new
    catalog table (default: the warehouse folder).
    """
    if schema is not None:
        df = conform(df, schema)
    if partition_by and files_per_partition:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    elif partition_by and not laid_out:
        df = df.hint("rebalance", *partition_by)
    if as_table and overwrite == "dynamic" and df.sparkSession.catalog.tableExists(target):
        _replace_partitions(df, target)
        return
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if overwrite == "dynamic":
        w = w.option("partitionOverwriteMode", "dynamic")
    if as_table:
        (w.option("path", location) if location else w).saveAsTable(target)
    else:
        w.save(target)


def _replace_partitions(df: DataFrame, target: str) -> None:
    """Insert into a catalog table by its column order, replacing the partitions that ``df`` holds.
    (``saveAsTable`` in overwrite mode would replace the whole table.)"""
    spark = df.sparkSession
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        df.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
    finally:
        spark.conf.set(name, before)


def write_layer(df: DataFrame, name: str, target: str, **kw) -> None:
    """``write_table`` with the declared schema and partitioning of layer table ``name``."""
    schema, parts = TABLES[name]
    write_table(df, target, schema=schema, partition_by=parts, **kw)


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
               where: Column | None = None, as_table: bool = False) -> DataFrame:
    """Read a layer table; a filter on partition columns becomes ``PartitionFilters`` and the
    column list becomes the Parquet ``ReadSchema``. Columns are always selected by name
    (partition columns move to the end of the schema on read)."""
    df = spark.table(source) if as_table else spark.read.parquet(source)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def read_year(spark: SparkSession, source: str, year: int, year_col: str = "travel_year",
              as_table: bool = False) -> DataFrame:
    """One year of a year-partitioned table (partition-pruned scan)."""
    return read_table(spark, source, where=F.col(year_col) == year, as_table=as_table)


def read_latest_year(spark: SparkSession, source: str, year_col: str = "travel_year", as_table: bool = False) -> DataFrame:
    """The last year of a year-partitioned table that has rows. The year is a subquery of the plan, over the
    partition column alone; when it runs, the scan of the rows is pruned to that year's files."""
    df = read_table(spark, source, as_table=as_table)
    return df.where(F.col(year_col) == df.select(F.max(year_col)).scalar())
