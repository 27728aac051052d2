"""Quality operators on small tables."""

import datetime

from tests.conftest import rows
from wayfarer.operators.quality import column_profile, conform_failures, duplicate_summary, value_histogram
from wayfarer.schemas import TABLES


def test_profile_compares_in_the_column_type(spark):
    df = spark.createDataFrame([(9, datetime.date(2020, 2, 1)), (10, datetime.date(2019, 12, 31)), (100, None)], "n int, d date")
    assert rows(column_profile(df, ["n", "d"])) == [("d", 3, 1, 0, "2019-12-31", "2020-02-01"), ("n", 3, 0, 0, "9", "100")]


def test_no_duplicates_is_zero(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(duplicate_summary(df, ["k"])) == [(0, 0)]
    assert rows(duplicate_summary(df.unionByName(df), ["k"])) == [(2, 2)]


def test_histogram_counts_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert rows(value_histogram(df, "c")) == [("a", 2), (None, 1)]


def test_conform_failures(spark):
    schema = TABLES["ods_poi_dim"][0]
    text = ", ".join(f"{f.name} string" for f in schema.fields)
    df = spark.createDataFrame([("1", *"abcd", "1.5", "x", "l", "m"), ("2", *"abcd", "n/a", None, "l", "m")], text)
    assert rows(conform_failures(df, schema)) == [("latitude", 2, 1), ("longitude", 1, 1)]
    assert rows(conform_failures(df.select("poi_id"), schema)) == []
