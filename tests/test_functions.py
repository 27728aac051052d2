import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from wayfarer.functions import (
    FIXTURE_RULES,
    REFERENCE_RULES,
    blank_to_null,
    classify,
    composite_id,
    days_since,
    map_text,
    parse_date_multi,
    period_label,
    quarter_of_month,
    split_keep_empty,
    top_keys,
)
from wayfarer.functions.dates import format_literals


def test_blank_to_null_keeps_untrimmed_and_tabs(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "\t"), (4, "a;b"), (5, " x ")], "id int, s string")
    out = dict(rows(df.select("id", blank_to_null("s").alias("s"))))
    assert out == {1: None, 2: None, 3: "\t", 4: "a;b", 5: " x "}


def test_split_keeps_empty_and_trailing(spark):
    df = spark.createDataFrame([("a;;b; ;",)], "s string")
    assert df.select(split_keep_empty("s", ";")).first()[0] == ["a", "", "b", " ", ""]
    df2 = spark.createDataFrame([("a|b||",)], "s string")
    assert df2.select(split_keep_empty("s", "|")).first()[0] == ["a", "b", "", ""]


def test_parse_date_multi_formats(spark):
    vals = ["2020/1/5", "2020/01/05", "2020-01-05", "20200105", "junk", None, "2020-1-5"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    got = [r[0] for r in df.select(parse_date_multi("d")).collect()]
    day = dt.date(2020, 1, 5)
    assert got == [day, day, day, day, None, None, None]


def test_format_literals():
    assert format_literals("yyyy/M/d") == ["/"]
    assert format_literals("yyyyMMdd") == []
    assert format_literals("yyyy'T'HH") == ["T"]


def test_quarter_and_label(spark):
    df = spark.createDataFrame([(2021, m) for m in range(1, 13)] + [(None, 3)], "y int, m int")
    out = df.select(quarter_of_month("m").alias("q"), period_label("y", quarter_of_month("m")).alias("l"))
    got = [tuple(r) for r in out.collect()]
    assert [q for q, _ in got] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]
    assert got[6][1] == "2021Q3" and got[-1][1] is None
    assert dict(out.dtypes)["q"] == "int"


def test_composite_id_skips_null(spark):
    df = spark.createDataFrame([("u", "2020/1/5"), ("u", None)], "a string, b string")
    assert [r[0] for r in df.select(composite_id("_", "a", "b")).collect()] == ["u_2020/1/5", "u"]


def test_reference_classifier_order(spark):
    cases = {
        "森林公园": "都市休闲",        # rule 5 before rule 7
        "无标签": "未分类",            # sentinel, none of the one-character nature keywords
        "欢乐谷;山": "主题游乐",       # rule 1 wins
        "博物馆": "文化场馆",
        "古镇;老街": "历史人文古迹",
        "摩天轮": "都市地标",
        "农家乐": "乡村生态",
        "湖泊": "自然风光",
        "购物": "其他景点",
    }
    df = spark.createDataFrame([(k,) for k in cases], "label string")
    got = dict(rows(df.select("label", classify("label", REFERENCE_RULES).alias("c"))))
    assert got == cases


def test_fixture_classifier_overlap(spark):
    df = spark.createDataFrame([("red;ring;PROMO",), ("red;gear",), ("无标签",), ("new;bolt;SMALL",)], "l string")
    got = [r[0] for r in df.select(classify("l", FIXTURE_RULES)).collect()]
    assert got == ["forged", "coloured", "unclassified", "other"]


def test_top_keys_ties_empty_null(spark):
    df = spark.createDataFrame(
        [(1, {"b": 3, "a": 3, "c": 1}), (2, {}), (3, None), (4, {"x": 5})],
        "id int, m map<string,bigint>")
    got = dict(rows(df.select("id", top_keys("m"))))
    assert got == {1: ["a", "b"], 2: None, 3: None, 4: ["x"]}


def test_map_text(spark):
    df = spark.createDataFrame([({"b": 2, "a": 10},), ({},), (None,)], "m map<string,bigint>")
    assert [r[0] for r in df.select(map_text("m")).collect()] == ["a=10|b=2", "", None]


def test_days_since(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2020, 12, 31),)], "d date")
    assert [r[0] for r in df.select(days_since("2022-01-01", "d")).collect()] == [365, 366]


def test_functions_stay_in_codegen(spark):
    df = spark.createDataFrame([("2020/1/5", "a;b")], "d string, s string")
    plan = df.select(parse_date_multi("d"), split_keep_empty("s"), classify("s", FIXTURE_RULES))
    assert "PythonUDF" not in plan._jdf.queryExecution().executedPlan().toString()
    assert F is not None


def test_optional_sections_are_parsed(spark):
    formats = ("yyyy/M/d", "yyyy-MM-dd[ HH:mm]", "yyyyMMdd['T'HH]", "d.M.yyyy['x']")
    texts = ["2020-01-05", "2020-01-05 10:30", "2020/1/5", "20200105", "20200105T07", "5.1.2020", "5.1.2020x", "junk", "2020-01-05 10"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_date("t", f) for f in formats])
    for r in df.select("t", parse_date_multi("t", formats).alias("guarded"), plain.alias("plain")).collect():
        assert r.guarded == r.plain, r
    got = [r[0] for r in df.select(parse_date_multi("t", formats)).collect()]
    assert all(got[:7]) and got[7:] == [None, None]
