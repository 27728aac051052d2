"""Physical-plan checks: pushdown, pruning, broadcast, WindowGroupLimit, shuffle counts."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.registry import Layers
from wayfarer.sources import read_year, write_layer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def L(spark):
    return Layers(spark, SF_SMALL, P)


def test_ansi_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_dimension_is_broadcast(L):
    p = plan(L.user_month)
    assert "BroadcastHashJoin" in p and "LeftOuter" in p and "SortMergeJoin" not in p


def test_quarterly_rollups_shuffle_counts(spark, L, tmp_path):
    # from a stored visits table: the fact side is shuffled for the pre-aggregation and once
    # more by POI; the aggregate and the growth window reuse that partitioning
    path = str(tmp_path / "visits")
    write_layer(L.visits, "dwd_user_travel_sequence_info", path)
    p = plan(jobs.attraction_quarter(spark.read.parquet(path), L.dwd_poi, P))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    fact = [k for k in keys if "travel_quarter" in k or re.fullmatch(r"poi_id#\d+, \d+", k)]
    assert len(fact) == 2, keys
    assert "Window" in p and "BroadcastHashJoin" in p


def test_top_cities_uses_window_group_limit(L):
    p = plan(jobs.top_cities(L.city_quarter, P))
    assert "WindowGroupLimit" in p


def test_partition_pruning_on_year(spark, L, tmp_path):
    path = str(tmp_path / "cq")
    write_layer(L.city_quarter, "dws_city_travel_quarter", path)
    df = read_year(spark, path, 2001)
    p = plan(df)
    assert re.search(r"PartitionFilters: \[.*travel_year.*= 2001", p)


def test_scan_prunes_columns(spark, L, tmp_path):
    path = str(tmp_path / "visits")
    write_layer(L.visits, "dwd_user_travel_sequence_info", path)
    v = spark.read.parquet(path)
    p = plan(jobs.city_quarter(v, L.dwd_poi, P))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    visit_scan = [s for s in schemas if "travel_partners" in s][0]
    assert "blog_id" not in visit_scan and "trip_id" not in visit_scan


def test_year_filter_runs_before_dedupe(L):
    p = plan(jobs.dedupe_trips(L.parsed, P))
    # the range filter sits below the aggregation (inside the scan stage)
    agg_at = p.find("SortAggregate")
    filt_at = p.rfind(">= 1995")
    assert filt_at > agg_at


def test_no_python_in_jobs(L):
    for df in (L.visits, L.user_month, L.attraction_quarter, L.city_quarter, jobs.user_portrait(L.user_month, P)):
        p = plan(df)
        assert "Python" not in p and "ArrowEval" not in p
    assert F is not None


def test_portrait_reads_and_shuffles_once(spark, L, tmp_path):
    path = str(tmp_path / "um")
    write_layer(L.user_month, "dws_user_travel_month", path)
    p = plan(jobs.user_portrait(spark.read.parquet(path), P))
    assert p.count("FileScan") == 1
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", p) == ["blog_id"] and p.count("Exchange") == 1


def test_user_month_moves_the_visits_once(spark, L, tmp_path):
    path, dim = str(tmp_path / "visits"), str(tmp_path / "poi")
    write_layer(L.visits, "dwd_user_travel_sequence_info", path)
    write_layer(L.dwd_poi, "dwd_poi_info", dim)
    p = plan(jobs.user_month(spark.read.parquet(path), spark.read.parquet(dim), P))
    usual, hot = p.split("LeftSemi")[0], p.split("LeftAnti")[0]
    assert "Union" in p and hot != p
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\), REPARTITION_BY_COL", p)
    assert len(moved) == 1 and [k.split("#")[0].strip() for k in moved[0].split(",")[:3]] == jobs.USER_MONTH
    above = p[:p.index("REPARTITION_BY_COL")]
    assert above.count("Exchange") == 1, usual  # nothing is shuffled again above it
    assert "SinglePartition" not in p


def test_trips_are_laid_out_before_they_are_exploded(L):
    p = plan(jobs.clean_trips(L.ods_trip, P, lay_out=True))
    assert 0 <= p.index("Generate explode") < p.index("REBALANCE_PARTITIONS")


def test_building_a_job_runs_nothing(spark, L, tmp_path):
    path, dim = str(tmp_path / "visits"), str(tmp_path / "poi")
    write_layer(L.visits, "dwd_user_travel_sequence_info", path)
    write_layer(L.dwd_poi, "dwd_poi_info", dim)
    visits, poi = spark.read.parquet(path), spark.read.parquet(dim)
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        for job in (jobs.user_month, jobs.attraction_quarter, jobs.city_quarter):
            job(visits, poi, P)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sort_merge_fallback_adds_no_shuffle(spark, L, tmp_path):
    # a dimension that may not be broadcast: the join's hash by POI is the partitioning the
    # aggregate and the growth window reuse, so the explicit repartition costs nothing extra
    path = str(tmp_path / "visits")
    write_layer(L.visits, "dwd_user_travel_sequence_info", path)
    df = jobs.attraction_quarter(spark.read.parquet(path), L.dwd_poi, P.with_(broadcast_poi="never"))
    p = final_plan(df)
    assert "SortMergeJoin" in p and "REPARTITION_BY_COL" not in p
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    fact = [k for k in keys if "travel_quarter" in k or re.fullmatch(r"poi_id#\d+, \d+", k)]
    assert len(fact) == 3, keys  # pre-aggregation, join (fact side), join (dimension side)


def test_trip_cleaning_pushes_null_filters(spark, L, tmp_path):
    path = str(tmp_path / "ods_trip")
    L.ods_trip.write.parquet(path)
    p = plan(jobs.clean_trips(spark.read.parquet(path), P))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    for c in ("blog_id", "departure_date", "visit_sequence"):
        assert f"IsNotNull({c})" in scan
    assert "retrieval_date" not in scan.split("ReadSchema")[1]
