import datetime as dt

import pytest

from tests.conftest import rows
from wayfarer.operators import dedupe, drop_null_keys, explode_sequence, fill_default, year_range
from wayfarer.plans import REFERENCE_PARAMS, jobs

TRIP = "blog_id string, retrieval_date string, departure_date string, travel_partners string, visit_sequence string"


def test_drop_null_keys_keeps_blank(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), (" ", "x"), ("a", None)], "k string, v string")
    assert set(rows(drop_null_keys(df, ["k", "v"]))) == {("", "x"), (" ", "x")}


def test_fill_default(spark):
    df = spark.createDataFrame([(None,), ("Family",)], "p string")
    assert rows(fill_default(df, "Unrecorded", ["p"])) == [("Family",), ("Unrecorded",)]


def test_year_range_bounds(spark):
    days = [dt.date(2010, 12, 31), dt.date(2011, 1, 1), dt.date(2021, 12, 31), dt.date(2022, 1, 1), None]
    df = spark.createDataFrame([(d, d.year if d else None) for d in days], "d date, y int")
    assert [r[0] for r in year_range(df, "y", 2011, 2022).orderBy("d").collect()] == [days[1], days[2]]


def test_dedupe_survivor_is_deterministic(spark):
    data = [("k", "b", 1), ("k", "a", 2), ("k", None, 0), ("j", "z", 9)]
    df = spark.createDataFrame(data, "k string, o string, r int")
    expect = [("j", "z", 9), ("k", "a", 2)]  # NULLs last, then smallest
    assert rows(dedupe(df, ["k"], order=["o"])) == expect
    assert rows(dedupe(df.repartition(3), ["k"], order=["o"], hash_lead=False)) == expect


def test_dedupe_hot_copy_group(spark):
    # one key holds most of the rows: still one survivor, other groups untouched
    data = [("hot", "2020/1/1", "Solo")] * 3000 + [(f"u{i}", "2020/1/1", "Solo") for i in range(50)]
    df = spark.createDataFrame(data, "k string, d string, p string").repartition(4)
    out = dedupe(df, ["k", "d"], order=["p"])
    assert out.count() == 51


def test_clean_trips_semantics(spark):
    raw = spark.createDataFrame([
        # same user + day in two layouts, same sequence -> one trip (smallest date text survives)
        ("u1", "r", "2015/3/1", "Solo", "p1;p2"),
        ("u1", "r", "2015-03-01", "Solo", "p1;p2"),
        # same user + day, another sequence -> second trip, its own id
        ("u1", "r", "20150301", None, "p3;;p3; ;"),
        # leading space kept (will not join), blanks dropped, repeats kept
        ("u2", "r", "2016/12/31", "Couple", " p1;p4;"),
        ("u3", "r", "junk", "Solo", "p1"),           # unparseable date
        ("u4", "r", "2022/1/1", "Solo", "p1"),       # out of range
        (None, "r", "2015/3/1", "Solo", "p1"),       # null key
        ("u5", "r", "2015/3/1", "Solo", None),       # null sequence
    ], TRIP)
    v = jobs.clean_trips(raw, REFERENCE_PARAMS)
    got = rows(v, "blog_id", "trip_id", "travel_date", "travel_partners", "poi_id", "travel_year", "travel_month")
    d = dt.date(2015, 3, 1)
    assert got == sorted([
        ("u1", "u1_2015-03-01", d, "Solo", "p1", 2015, 3),
        ("u1", "u1_2015-03-01", d, "Solo", "p2", 2015, 3),
        ("u1", "u1_20150301", d, "Unrecorded", "p3", 2015, 3),
        ("u1", "u1_20150301", d, "Unrecorded", "p3", 2015, 3),
        ("u2", "u2_2016/12/31", dt.date(2016, 12, 31), "Couple", " p1", 2016, 12),
        ("u2", "u2_2016/12/31", dt.date(2016, 12, 31), "Couple", "p4", 2016, 12),
    ], key=repr)
    assert dict(v.dtypes)["travel_year"] == "int"


def test_explode_sequence(spark):
    df = spark.createDataFrame([("t", "a;;b; ;a")], "t string, s string")
    assert [r.x for r in explode_sequence(df, "s", "x").collect()] == ["a", "b", "a"]


def test_clean_poi(spark):
    ods = spark.createDataFrame([
        ("1", "A", None, "c1", None, None, None, "森林公园;山", None),
        ("2", "B", None, "c1", None, None, None, "  ", None),
        ("3", "C", None, "c2", None, None, None, None, None),
        ("4", None, None, "c2", None, None, None, "博物馆", None),
        ("5", "E", None, None, None, None, None, "博物馆", None),
        ("6", "F", None, "c3", None, None, None, "\t", None),
    ], "poi_id string, name_zh string, name_en string, city_zh string, city_en string, latitude decimal(10,6), "
       "longitude decimal(10,6), label_zh string, label_en string")
    got = rows(jobs.clean_poi(ods, REFERENCE_PARAMS))
    assert got == [
        ("1", "A", "c1", ["森林公园", "山"], "都市休闲"),
        ("2", "B", "c1", ["无标签"], "未分类"),
        ("3", "C", "c2", ["无标签"], "未分类"),
        ("6", "F", "c3", ["\t"], "其他景点"),
    ]


@pytest.mark.parametrize("fmt_col", ["departure_date"])
def test_trip_id_uses_raw_text(spark, fmt_col):
    raw = spark.createDataFrame([("u", "r", "2015/3/1", "S", "a"), ("u", "r", "20150301", "S", "b")], TRIP)
    ids = sorted(r.trip_id for r in jobs.clean_trips(raw, REFERENCE_PARAMS).collect())
    assert ids == ["u_2015/3/1", "u_20150301"]  # same day, two trips
