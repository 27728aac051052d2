"""Declared catalog tables: text tables over delimited files, Parquet tables, comments on both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wayfarer.schemas import TABLE_COMMENTS, TABLES, conform

TEXT_TABLES = ("ods_user_travel_sequence", "ods_poi_dim")
# A NULL is written as \N, so that an empty text stays one; a delimiter within a value is quoted.
TEXT_OPTIONS = {"sep": ",", "header": "false", "encoding": "UTF-8", "nullValue": "\\N", "quote": '"', "escape": '"',
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(name: str, table: str | None = None, location: str | None = None, text: bool | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` for layer table ``name``, as ``table`` (default: in its layer's database):
    the declared columns and partitioning with the comments of columns and table. ``text`` (default: the two
    raw tables) declares delimited files. With ``location`` the table is external: dropping it leaves the
    files."""
    schema, parts = TABLES[name]
    text = name in TEXT_TABLES if text is None else text
    lines = []
    for f in schema.fields:
        note = f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata.get("comment") else ""
        lines.append(f"  `{f.name}` {f.dataType.simpleString()}{note}")
    out = [f"CREATE TABLE IF NOT EXISTS {table or name.split('_')[0] + '.' + name} (", ",\n".join(lines), ")",
           f"USING {'csv' if text else 'parquet'}"]
    if text:
        out.append("OPTIONS (" + ", ".join(f"{_quoted(k)} {_quoted(v)}" for k, v in TEXT_OPTIONS.items()) + ")")
    if parts:
        out.append("PARTITIONED BY (" + ", ".join(parts) + ")")
    out.append(f"COMMENT {_quoted(TABLE_COMMENTS[name])}")
    if location:
        out.append(f"LOCATION {_quoted(location)}")
    return "\n".join(out)


def create_declared(spark: SparkSession, name: str, table: str | None = None, location: str | None = None,
                    text: bool | None = None) -> str:
    """Create layer table ``name`` in the catalog if it is not there; returns the table's name."""
    spark.sql(table_ddl(name, table, location, text))
    return table or f"{name.split('_')[0]}.{name}"


def create_all(spark: SparkSession, warehouse: str | None = None) -> list[str]:
    """All ten layer tables, external under ``warehouse`` if given, else managed by the catalog."""
    made = []
    for name in TABLES:
        layer = name.split("_")[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        made.append(create_declared(spark, name, location=f"{warehouse.rstrip('/')}/{layer}/{name}" if warehouse else None))
    return made


def load_declared(df: DataFrame, name: str, table: str | None = None) -> None:
    """Replace the rows of a declared catalog table. The table itself stays, with its comments, format and
    place (``saveAsTable`` would make it anew); ``df`` is cast to the declared columns first. Texts with line
    breaks can't be kept in a text table: they fail the load."""
    spark, table = df.sparkSession, table or f"{name.split('_')[0]}.{name}"
    rows = conform(df, TABLES[name][0])
    provider = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Provider'").first()
    if provider and provider["data_type"].lower() == "csv":
        broken = {f.name: F.raise_error(F.lit(f"{table}: line break in {f.name}")).cast("string")
                  for f in TABLES[name][0].fields if isinstance(f.dataType, StringType)}
        rows = rows.withColumns({c: F.when(F.col(c).rlike(r"[\r\n]"), error).otherwise(F.col(c)) for c, error in broken.items()})
    rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
