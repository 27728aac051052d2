import datetime as dt

from tests.conftest import rows
from wayfarer.plans import REFERENCE_PARAMS, jobs

UM = ("blog_id string, trip_total_cnt bigint, total_spot_cnt bigint, city_visit_map map<string,bigint>, "
      "category_visit_map map<string,bigint>, partner_visit_map map<string,bigint>, first_trip_date date, "
      "last_trip_date date, travel_year int, travel_month int")


def test_user_portrait(spark):
    d = dt.date
    um = spark.createDataFrame([
        # 6 trips over 2 years -> avg 3 -> high; last trip 2021-01-01 is exactly 365 days -> active
        ("a", 2, 5, {"c1": 3, "c2": 2}, {"k": 5}, {"Solo": 5}, d(2020, 1, 1), d(2020, 1, 9), 2020, 1),
        ("a", 4, 4, {"c2": 3, "c1": 0}, {"k": 4}, {"Duo": 4}, d(2021, 1, 1), d(2021, 1, 1), 2021, 1),
        # 299 / 100 years would be 2.99: one user with 2.99 trips per year is mid
        ("b", 1, 1, {}, {}, {"Solo": 1}, d(2020, 12, 31), d(2020, 12, 31), 2020, 12),
    ], UM)
    out = {r.blog_id: r for r in jobs.user_portrait(um, REFERENCE_PARAMS).collect()}
    a, b = out["a"], out["b"]
    assert (a.total_trips, a.total_spots) == (6, 9)
    assert a.favorite_city == ["c2"] and a.favorite_category == ["k"] and a.favorite_partner == ["Solo"]
    assert (a.user_level, a.user_status) == ("高频", "活跃")
    # empty maps give NULL favourites; 366 days -> churned; 1 trip / 1 year -> mid
    assert b.favorite_city is None and b.favorite_partner == ["Solo"]
    assert (b.user_level, b.user_status) == ("中频", "流失")


def test_levels_boundaries(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(300, 100), (299, 100), (100, 100), (0, 0)], "t long, y long")
    got = [r[0] for r in df.select(jobs.user_level("t", "y", REFERENCE_PARAMS)).collect()]
    assert got == ["高频", "中频", "中频", "低频"]
    assert F is not None


def test_favourite_ties_sorted(spark):
    um = spark.createDataFrame([
        ("a", 1, 4, {"z": 2, "m": 2}, {"k": 4}, {"S": 2, "D": 2}, None, None, 2020, 1),
    ], UM)
    r = jobs.user_portrait(um, REFERENCE_PARAMS).first()
    assert r.favorite_city == ["m", "z"] and r.favorite_partner == ["D", "S"]
    assert rows(um.select("blog_id"))[0] == ("a",)


def test_int_valued_maps(spark):
    um = spark.createDataFrame([
        ("a", 1, 3, {"c": 3}, {"k": 3}, {"S": 3}, None, dt.date(2021, 6, 1), 2021, 6),
    ], UM.replace("map<string,bigint>", "map<string,int>").replace("bigint", "int"))
    r = jobs.user_portrait(um, REFERENCE_PARAMS).first()
    assert (r.total_trips, r.favorite_city, r.user_status) == (1, ["c"], "活跃")
