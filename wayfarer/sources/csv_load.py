"""Raw CSV sources: header row, UTF-8, every column a string, renamed by a mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wayfarer.schemas import ODS_POI, ODS_TRIP, conform

# Header names of the two source files and the column each one becomes.
POI_CSV_COLUMNS = {
    "Encrypted_ID": "poi_id",
    "Name_ZH": "name_zh",
    "Name_EN": "name_en",
    "City_ZH": "city_zh",
    "City_EN": "city_en",
    "Latitude_GCJ02": "latitude",
    "Longitude_GCJ02": "longitude",
    "Label_ZH": "label_zh",
    "Label_EN": "label_en",
}
TRIP_CSV_COLUMNS = {
    "Anonymized_Blog_ID": "blog_id",
    "Retrieval_Date": "retrieval_date",
    "Departure_Date": "departure_date",
    "Travel_Partners": "travel_partners",
    "Visit_Sequence": "visit_sequence",
}


def read_csv_mapped(spark: SparkSession, path: str, mapping: Mapping[str, str],
                    schema: StructType | None = None) -> DataFrame:
    """Read a headed CSV without type inference (no extra pass over the data), keep and rename
    the mapped columns, then cast to ``schema`` when given. Empty fields read as NULL.

    The header of one file gives the all-string schema; a file of the folder whose header differs
    (another order, other names) fails the read instead of having its columns mixed up."""
    header = spark.read.csv(path, header=True, encoding="utf-8", inferSchema=False).columns
    missing = [c for c in mapping if c not in header]
    if missing:
        raise ValueError(f"{path}: header lacks {missing}")
    text = StructType([StructField(c, StringType()) for c in header])
    raw = spark.read.csv(path, schema=text, header=True, encoding="utf-8", enforceSchema=False)
    df = raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])
    return conform(df, schema) if schema is not None else df


def read_poi_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_mapped(spark, path, POI_CSV_COLUMNS, ODS_POI)


def read_trip_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_mapped(spark, path, TRIP_CSV_COLUMNS, ODS_TRIP)


def write_source_csv(df: DataFrame, path: str, mapping: Mapping[str, str]) -> None:
    """Write ODS-named columns back under their source header names (used to build test input)."""
    # Spark's CSV writer trims values by default; keep them byte-exact (a space-only label must
    # stay space-only, it is not the same as an empty field, which reads back as NULL)
    (df.select(*[F.col(dst).cast("string").alias(src) for src, dst in mapping.items()])
       .write.mode("overwrite").option("header", True).option("encoding", "utf-8")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
