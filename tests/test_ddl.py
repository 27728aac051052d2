"""Declared catalog tables, staged replacement, the last year by a subquery."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans.registry import Layers
from wayfarer.schemas import TABLE_COMMENTS, TABLES
from wayfarer.sources.ddl import create_all, create_declared, load_declared, table_ddl
from wayfarer.sources.files import exists, folders, read_text, write_text
from wayfarer.sources.staged import current_version, read_staged, replace_staged, switch_location
from wayfarer.sources.tables import create_layer_databases, read_latest_year, write_layer


@pytest.fixture(scope="module")
def L(spark):
    create_layer_databases(spark)
    return Layers(spark, SF_SMALL, P)


def described(spark, table):
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def test_all_ten_tables_have_their_comments(spark, tmp_path):
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {name.split('_')[0]}.{name}")
    made = create_all(spark, str(tmp_path))
    try:
        assert len(made) == 10
        for table in made:
            name = table.split(".")[1]
            about = described(spark, table)
            assert about["Comment"] == TABLE_COMMENTS[name] and about["Type"] == "EXTERNAL"
            assert about["Provider"] == ("csv" if name.startswith("ods") else "parquet")
            notes = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table}").collect()}
            schema, parts = TABLES[name]
            assert all(notes[f.name] == f.metadata.get("comment") for f in schema.fields)
            assert all("# col_name" in notes and p in notes for p in parts)
        assert create_all(spark, str(tmp_path)) == made  # again: they stay
    finally:
        for table in made:
            spark.sql(f"DROP TABLE {table}")


def test_text_table_keeps_every_value(spark, tmp_path, L):
    place = str(tmp_path / "poi")
    table = create_declared(spark, "ods_poi_dim", "ods.text_poi", place)
    try:
        odd = spark.createDataFrame([("1", None, "", "a,b", 'say "x"', "1.5", None, "  ", "\\N x")],
                                    ", ".join(f"{f.name} string" for f in TABLES["ods_poi_dim"][0].fields))
        load_declared(odd, "ods_poi_dim", table)
        r = spark.table(table).first()
        assert (r.name_zh, r.name_en, r.city_zh, r.city_en, r.label_zh, r.label_en) == (None, "", "a,b", 'say "x"', "  ", "\\N x")
        assert str(r.latitude) == "1.500000" and r.longitude is None
        load_declared(L.ods_poi, "ods_poi_dim", table)
        assert rows(spark.table(table)) == rows(L.ods_poi)
        assert described(spark, table)["Comment"] == TABLE_COMMENTS["ods_poi_dim"]
        files = spark.read.text(place)
        assert files.count() == L.ods_poi.count() and "," in files.first()[0]
    finally:
        spark.sql(f"DROP TABLE {table}")
    assert exists(spark, place)  # external: the files stay


def test_line_breaks_fail_a_text_load(spark, tmp_path):
    table = create_declared(spark, "ods_user_travel_sequence", "ods.text_trips", str(tmp_path / "t"))
    df = spark.createDataFrame([("1", "d", "e", "x\ny", "s")], ", ".join(f"{f.name} string" for f in TABLES["ods_user_travel_sequence"][0].fields))
    with pytest.raises(Exception, match="line break in travel_partners"):
        load_declared(df, "ods_user_travel_sequence", table)
    spark.sql(f"DROP TABLE {table}")


def test_loading_a_partitioned_table_keeps_its_declaration(spark, tmp_path, L):
    table = create_declared(spark, "dws_city_travel_quarter", "dws.declared_cq", str(tmp_path / "cq"))
    try:
        for _ in range(2):
            load_declared(L.city_quarter, "dws_city_travel_quarter", table)
        assert spark.table(table).count() == L.city_quarter.count()
        assert described(spark, table)["Comment"] == TABLE_COMMENTS["dws_city_travel_quarter"]
        assert "PartitionFilters: [isnotnull(travel_year" in plan(spark.table(table).where("travel_year = 2000"))
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_quotes_in_comments_and_places(spark, monkeypatch):
    monkeypatch.setitem(TABLE_COMMENTS, "dwd_poi_info", "it's a \\ table")
    spark.sql(table_ddl("dwd_poi_info", "dwd.quoted"))
    assert described(spark, "dwd.quoted")["Comment"] == "it's a \\ table"
    spark.sql("DROP TABLE dwd.quoted")


# -- staged replacement ---------------------------------------------------------------------------
def test_a_failed_write_leaves_the_old_version(spark, tmp_path, L):
    table = str(tmp_path / "staged")
    first = replace_staged(L.city_quarter, "dws_city_travel_quarter", table)
    before = rows(read_staged(spark, table).select("city", "visit_trip_cnt", "travel_year"))
    broken = L.city_quarter.withColumn("visit_trip_cnt", F.when(F.col("travel_year") == 2000, F.raise_error(F.lit("mid-write"))).otherwise(1))
    with pytest.raises(Exception, match="mid-write"):
        replace_staged(broken, "dws_city_travel_quarter", table)
    assert current_version(spark, table) == first
    assert rows(read_staged(spark, table).select("city", "visit_trip_cnt", "travel_year")) == before

    def none_missing(df):
        if df.count() < len(before):
            raise ValueError("rows are missing")

    with pytest.raises(ValueError, match="missing"):
        replace_staged(L.city_quarter.where("travel_year > 1996"), "dws_city_travel_quarter", table, check=none_missing)
    assert current_version(spark, table) == first
    replace_staged(L.city_quarter, "dws_city_travel_quarter", table, check=none_missing)
    assert current_version(spark, table) != first


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark, tmp_path, L):
    table = str(tmp_path / "staged")
    plus = lambda n: L.city_quarter.withColumn("visit_trip_cnt", F.lit(n))
    replace_staged(plus(1), "dws_city_travel_quarter", table)
    reader = read_staged(spark, table).select(F.max("visit_trip_cnt"))
    replace_staged(plus(2), "dws_city_travel_quarter", table)
    assert reader.first()[0] == 1 and read_staged(spark, table).select(F.max("visit_trip_cnt")).first()[0] == 2
    replace_staged(read_staged(spark, table).withColumn("visit_trip_cnt", F.lit(3)), "dws_city_travel_quarter", table)
    assert read_staged(spark, table).select(F.max("visit_trip_cnt")).first()[0] == 3
    assert len([f for f in folders(spark, table) if f.startswith("v-")]) == 2  # the current one and the one before
    with pytest.raises(FileNotFoundError):
        read_staged(spark, str(tmp_path / "none"))


def test_the_location_of_a_catalog_table_is_switched(spark, tmp_path, L):
    place = str(tmp_path / "poi")
    table = create_declared(spark, "dwd_poi_info", "dwd.switched", f"{place}/empty")
    try:
        for n in (1, 2):
            at = switch_location(spark, table, "dwd_poi_info", L.dwd_poi.withColumn("city", F.lit(str(n))), place)
            assert rows(spark.table(table).select("city").distinct()) == [(str(n),)]
            assert described(spark, table)["Location"].endswith(at.rsplit("/", 1)[1])
        broken = L.dwd_poi.withColumn("city", F.raise_error(F.lit("mid-write")).cast("string"))
        with pytest.raises(Exception, match="mid-write"):
            switch_location(spark, table, "dwd_poi_info", broken, place)
        assert spark.table(table).count() == L.dwd_poi.count()
        assert described(spark, table)["Comment"] == TABLE_COMMENTS["dwd_poi_info"]
    finally:
        spark.sql(f"DROP TABLE {table}")


# -- the last year --------------------------------------------------------------------------------
def test_the_last_year_is_a_subquery_of_the_scan(spark, tmp_path, L):
    path = str(tmp_path / "cq")
    write_layer(L.city_quarter, "dws_city_travel_quarter", path)
    df = read_latest_year(spark, path)
    assert re.search(r"PartitionFilters: \[[^\]]*travel_year[^\]]*Subquery", plan(df))
    assert {r[0] for r in df.select("travel_year").distinct().collect()} == {2001}
    assert df.count() == L.city_quarter.where("travel_year = 2001").count()


# -- small files ----------------------------------------------------------------------------------
def test_small_files(spark, tmp_path):
    path = str(tmp_path / "a b" / "x.json")
    assert read_text(spark, path) is None and not exists(spark, path)
    write_text(spark, path, "né\n")
    write_text(spark, path, "second é")
    assert read_text(spark, path) == "second é" and exists(spark, path) and folders(spark, str(tmp_path)) == ["a b"]
    assert folders(spark, str(tmp_path / "none")) == []
