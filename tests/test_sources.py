"""Catalog tables, CSV load, declared schemas and session sizing."""

import pytest
from pyspark.sql import functions as F

from wayfarer.schemas import DWS_CITY_QUARTER, TABLES, conform
from wayfarer.session import scale_conf
from wayfarer.sources import (
    POI_CSV_COLUMNS,
    create_layer_databases,
    read_csv_mapped,
    read_table,
    write_source_csv,
    write_table,
)


def test_catalog_tables_round_trip(spark):
    create_layer_databases(spark)
    assert {"ods", "dwd", "dws", "ads"} <= {d.name for d in spark.catalog.listDatabases()}
    df = spark.createDataFrame([("c", 3, 1, {"S": 3}, 0.0, "no", 2021, 2)],
                               "city string, visit_trip_cnt bigint, unique_attraction_cnt bigint, "
                               "partner_map map<string,bigint>, visit_cnt_growth_rate double, is_hot_rising string, "
                               "travel_year int, travel_quarter int")
    write_table(df, "dws.dws_city_travel_quarter", DWS_CITY_QUARTER, ("travel_year", "travel_quarter"), as_table=True)
    back = read_table(spark, "dws.dws_city_travel_quarter", where=F.col("travel_year") == 2021, as_table=True)
    assert back.collect()[0].partner_map == {"S": 3}
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(travel_year" in plan and back.count() == 1


def test_csv_mapping_requires_headers(spark, tmp_path):
    df = spark.createDataFrame([("1", "n")], "poi_id string, name_zh string")
    df.write.option("header", True).csv(str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        read_csv_mapped(spark, str(tmp_path / "bad"), POI_CSV_COLUMNS)


def test_csv_round_trip_keeps_blanks(spark, tmp_path):
    cols = list(POI_CSV_COLUMNS.values())
    df = spark.createDataFrame([("1", None, "", "c", "c", "1.5", "2", "  ", "x")], ", ".join(f"{c} string" for c in cols))
    write_source_csv(df, str(tmp_path / "p"), POI_CSV_COLUMNS)
    r = read_csv_mapped(spark, str(tmp_path / "p"), POI_CSV_COLUMNS, TABLES["ods_poi_dim"][0]).first()
    assert r.name_zh is None and r.name_en is None and r.label_zh == "  " and str(r.latitude) == "1.500000"


def test_conform_casts_and_orders(spark):
    df = spark.createDataFrame([(2021, "c")], "travel_year long, city string")
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    schema = StructType([StructField("city", StringType()), StructField("travel_year", IntegerType())])
    out = conform(df, schema)
    assert out.columns == ["city", "travel_year"] and dict(out.dtypes)["travel_year"] == "int"
    with pytest.raises(ValueError):
        conform(df.drop("city"), schema)


def test_scale_conf():
    c = scale_conf(100 << 40)  # 100 TiB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "8"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b")], "v int, travel_year int, s string")
    write_table(df, path, partition_by=("travel_year",))
    write_table(spark.createDataFrame([(3, 2021, "c")], "v int, travel_year int, s string"), path,
                partition_by=("travel_year",), overwrite="dynamic")
    got = sorted((r.v, r.travel_year) for r in spark.read.parquet(path).collect())
    assert got == [(1, 2020), (3, 2021)]


def test_dynamic_overwrite_of_a_catalog_table_keeps_other_partitions(spark, tmp_path):
    create_layer_databases(spark)
    df = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b")], "v int, travel_year int, s string")
    for k in range(2):  # the first write makes the table, also in dynamic mode
        write_table(df, "dws.kept", partition_by=("travel_year",), as_table=True, location=str(tmp_path / "kept"),
                    overwrite="dynamic" if k else "static")
    new = spark.createDataFrame([("c", 2021, 3)], "s string, travel_year int, v int")  # other column order
    write_table(new, "dws.kept", partition_by=("travel_year",), as_table=True, overwrite="dynamic")
    got = sorted((r.v, r.travel_year, r.s) for r in spark.table("dws.kept").collect())
    assert got == [(1, 2020, "a"), (3, 2021, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_csv_files_with_another_header_fail(spark, tmp_path):
    path = tmp_path / "mixed"
    path.mkdir()
    (path / "a.csv").write_text("A,B\n1,2\n")
    (path / "b.csv").write_text("B,A\n4,3\n")
    with pytest.raises(Exception, match="header"):
        read_csv_mapped(spark, str(path), {"A": "a", "B": "b"}).collect()
    (path / "b.csv").write_text("A,B\n3,4\n")
    got = sorted(tuple(r) for r in read_csv_mapped(spark, str(path), {"B": "b", "A": "a"}).collect())
    assert got == [("2", "1"), ("4", "3")]


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from wayfarer import session

    def fake(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda name, default=None: default))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(master))
    assert session.shared_dir(fake("local[2]"))


def test_comments_reach_catalog_tables(spark, tmp_path):
    create_layer_databases(spark)
    schema, _ = TABLES["dwd_poi_info"]
    write_table(spark.createDataFrame([], schema), "dwd.commented", schema, as_table=True, location=str(tmp_path / "c"))
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE dwd.commented").collect()}
    assert comments == {f.name: f.metadata["comment"] for f in schema.fields}


def test_malformed_text_becomes_null(spark):
    from pyspark.sql.types import DecimalType, StructField, StructType
    df = spark.createDataFrame([("30.5",), ("n/a",)], "latitude string")
    out = conform(df, StructType([StructField("latitude", DecimalType(10, 6))]))
    assert [None if r[0] is None else str(r[0]) for r in out.collect()] == ["30.500000", None]


def test_files_per_partition_layout(spark, tmp_path):
    import os
    path = str(tmp_path / "salted")
    rows = [(i, 2020 + i % 2, f"s{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "v int, travel_year int, s string").repartition(8)
    write_table(df, path, partition_by=("travel_year",), files_per_partition=2)
    for year in (2020, 2021):
        files = [f for f in os.listdir(os.path.join(path, f"travel_year={year}")) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == list(range(400))
