"""Property checks over the sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.registry import Layers, canonical


@pytest.fixture(scope="module")
def L(spark):
    return Layers(spark, SF_SMALL, P)


def _map_sum(c):
    return F.aggregate(F.map_values(c), F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def test_partner_map_sums_to_visits(L):
    aq = L.attraction_quarter
    assert aq.filter(_map_sum("partner_map") != F.col("visit_total_cnt")).count() == 0
    um = L.user_month
    assert um.filter(_map_sum("partner_visit_map") != F.col("total_spot_cnt")).count() == 0
    assert um.filter(_map_sum("city_visit_map") > F.col("total_spot_cnt")).count() == 0


def test_attraction_and_city_totals_agree(L):
    a = L.attraction_quarter.groupBy("travel_year", "travel_quarter").agg(F.sum("visit_total_cnt").alias("n"))
    c = L.city_quarter.groupBy("travel_year", "travel_quarter").agg(F.sum("visit_trip_cnt").alias("n"))
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_ranks_dense_from_one(L):
    t = jobs.top_attractions(L.attraction_quarter, P)
    per_q = t.groupBy("year_quarter").agg(F.count("*").alias("n"), F.max("rank").alias("mx"), F.min("rank").alias("mn"))
    assert per_q.filter((F.col("n") != F.col("mx")) | (F.col("mn") != 1) | (F.col("n") > 50)).count() == 0


def test_first_period_flag(L):
    aq = L.attraction_quarter
    first = aq.groupBy("poi_id").agg(F.min(F.col("travel_year") * 4 + F.col("travel_quarter")).alias("f"))
    j = aq.join(first, "poi_id").withColumn("is_first", F.col("travel_year") * 4 + F.col("travel_quarter") == F.col("f"))
    none_flag = P.rising_flags[0]
    assert j.filter(F.col("is_first") != (F.col("is_hot_rising") == none_flag)).count() == 0
    assert j.filter(F.col("is_first") & (F.col("visit_cnt_growth_rate") != 0)).count() == 0


def test_portrait_invariants(L):
    up = jobs.user_portrait(L.user_month, P)
    assert up.filter(F.col("user_level") == P.user_levels[2]).count() == 0
    assert up.filter(F.size("favorite_partner") < 1).count() == 0


def test_invariant_under_input_repartitioning(spark, L):
    shuffled = Layers(spark, SF_SMALL, P)
    shuffled.__dict__["ods_trip"] = L.ods_trip.repartition(7, "visit_sequence")
    shuffled.__dict__["ods_poi"] = L.ods_poi.repartition(3)
    for name in ("user_month", "attraction_quarter", "city_quarter"):
        a, b = canonical(getattr(L, name)), canonical(getattr(shuffled, name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    ta = canonical(jobs.top_attractions(L.attraction_quarter, P))
    tb = canonical(jobs.top_attractions(shuffled.attraction_quarter, P))
    assert ta.exceptAll(tb).count() == 0
