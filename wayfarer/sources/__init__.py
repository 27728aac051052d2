"""Sources and sinks: raw CSV, layer tables on Parquet, and the test-table mapping."""

from wayfarer.sources.csv_load import (
    POI_CSV_COLUMNS,
    TRIP_CSV_COLUMNS,
    read_csv_mapped,
    read_poi_csv,
    read_trip_csv,
    write_source_csv,
)
from wayfarer.sources.tables import create_layer_databases, read_table, read_year, write_layer, write_table

__all__ = [
    "POI_CSV_COLUMNS", "TRIP_CSV_COLUMNS", "read_csv_mapped", "read_poi_csv", "read_trip_csv",
    "write_source_csv", "create_layer_databases", "read_table", "read_year", "write_layer", "write_table",
]
