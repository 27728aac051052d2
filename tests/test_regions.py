"""The place hierarchy: mapping, grouping sets, shares."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer.operators.enrich import DuplicateKeyError
from wayfarer.operators.regions import UNMAPPED, hierarchy_rollup, region_dim, share_of_parent, with_regions
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.registry import Layers
from wayfarer.sources.testdata import raw_regions

MAPPING = [("a", "p1", "r1"), (" b ", "p1", "r1"), ("c", "p2", "r1"), ("d", None, " "), ("e", "p9", "r2"), ("e", "p3", "r2"), (None, "x", "y"), ("", "x", "y")]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(MAPPING, "city string, province string, region string")


def test_mapping_is_unique_and_trimmed(dim):
    assert rows(region_dim(dim)) == [("a", "p1", "r1"), ("b", "p1", "r1"), ("c", "p2", "r1"), ("d", UNMAPPED, UNMAPPED), ("e", "p3", "r2")]
    with pytest.raises(DuplicateKeyError):
        region_dim(dim, "error")


def test_levels_and_shares(spark, dim):
    facts = spark.createDataFrame([(1, c, n) for c, n in (("a", 10), ("b", 30), ("c", 60), ("d", 5), ("e", 95), ("zz", 0))] + [(2, "a", 7)],
                                  "q int, city string, n bigint")
    out = hierarchy_rollup(with_regions(facts, region_dim(dim)), ["q"], {"n": F.sum("n"), "cities": F.count(F.lit(1))})
    got = {tuple(r)[:5]: tuple(r)[5:] for r in share_of_parent(out, ["q"], "n", "share").collect()}
    assert got[(1, "total", None, None, None)] == (200, 6, None)
    assert got[(1, "region", "r1", None, None)] == (100, 3, 0.5) and got[(1, "region", UNMAPPED, None, None)] == (5, 2, 0.025)
    assert got[(1, "province", "r1", "p1", None)] == (40, 2, 0.4) and got[(1, "city", "r1", "p1", "b")] == (30, 1, 0.75)
    assert got[(1, "city", UNMAPPED, UNMAPPED, "zz")] == (0, 1, 0.0) and got[(2, "total", None, None, None)] == (7, 1, None)
    assert len(got) == 1 + 3 + 4 + 6 + 4


def test_a_null_value_is_no_subtotal(spark):
    df = spark.createDataFrame([(1, "r", None, "c", 2), (1, "r", "p", "c", 3)], "q int, region string, province string, city string, n int")
    got = rows(hierarchy_rollup(df, ["q"], {"n": F.sum("n")}), "level", "province", "n")
    assert ("province", None, 2) in got and ("region", None, 5) in got and len(got) == 6


def test_quarterly_levels_add_up(spark):
    L = Layers(spark, SF_SMALL, P)
    df = jobs.region_quarter(L.city_quarter, raw_regions(spark, SF_SMALL), P)
    sums = rows(df.groupBy("travel_year", "travel_quarter", "level").agg(F.sum("visit_trip_cnt").alias("v"), F.sum("city_cnt").alias("c")))
    by_quarter = {}
    for y, q, _, v, c in sums:
        by_quarter.setdefault((y, q), set()).add((v, c))
    assert all(len(x) == 1 for x in by_quarter.values()) and len(sums) == 4 * len(by_quarter)
    assert {r[0] for r in df.where("level = 'region'").select("region").distinct().collect()} >= {UNMAPPED, "R0", "R1"}


def test_one_aggregate_over_the_city_table(spark, tmp_path):
    L = Layers(spark, SF_SMALL, P)
    path = str(tmp_path / "cq")
    L.city_quarter.write.parquet(path)
    p = plan(jobs.region_quarter(spark.read.parquet(path), raw_regions(spark, SF_SMALL), P))
    assert p.count("Expand") == 1 and len([x for x in p.splitlines() if "FileScan" in x and "visit_trip_cnt" in x]) == 1
