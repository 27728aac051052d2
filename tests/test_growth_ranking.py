import pytest

from tests.conftest import rows
from wayfarer.operators import argmax_set, period_over_period, top_n_per_group
from pyspark.sql import functions as F

FLAGS = ("none", "yes", "no")


def _growth(spark, data, gap="bridge"):
    df = spark.createDataFrame(data, "e string, y int, q int, n long")
    out = period_over_period(df, ["e"], "n", ("y", "q"), 4, 0.3, gap, FLAGS, "rate", "flag")
    return {(r.e, r.y, r.q): (r.rate, r.flag) for r in out.collect()}


def test_growth_cases(spark):
    data = [("a", 2020, 1, 10), ("a", 2020, 2, 13), ("a", 2020, 3, 14),   # 0.3 -> no ; 0.0769 -> no
            ("b", 2020, 1, 10), ("b", 2020, 2, 14),                       # 0.4 -> yes
            ("c", 2020, 1, 10), ("c", 2020, 4, 5),                        # skipped quarters, fall
            ("d", 2020, 1, 100000), ("d", 2020, 2, 130001)]               # 0.30001 rounds to 0.3 -> no
    g = _growth(spark, data)
    assert g[("a", 2020, 1)] == (0.0, "none")
    assert g[("a", 2020, 2)] == (0.3, "no")
    assert g[("a", 2020, 3)] == (0.0769, "no")
    assert g[("b", 2020, 2)] == (0.4, "yes")
    assert g[("c", 2020, 4)] == (-0.5, "no")          # bridged to 2020Q1
    assert g[("d", 2020, 2)] == (0.3, "no")


def test_growth_strict_gap(spark):
    data = [("c", 2020, 1, 10), ("c", 2020, 4, 5), ("c", 2021, 1, 20), ("e", 2020, 4, 4), ("e", 2021, 1, 8)]
    g = _growth(spark, data, gap="strict")
    assert g[("c", 2020, 1)] == (0.0, "none")
    assert g[("c", 2020, 4)] == (0.0, "no")            # previous calendar quarter absent -> prev 0
    assert g[("c", 2021, 1)] == (3.0, "yes")           # 2020Q4 is the calendar neighbour of 2021Q1
    assert g[("e", 2021, 1)] == (1.0, "yes")
    with pytest.raises(ValueError):
        _growth(spark, data, gap="sometimes")


def test_top_n_tie_at_cut(spark):
    df = spark.createDataFrame([("q", f"p{i}", c) for i, c in enumerate([9, 5, 5, 5, 1])], "g string, id string, c long")
    out = top_n_per_group(df, ["g"], [F.col("c").desc(), F.col("id")], 3)
    assert rows(out, "id", "rank") == [("p0", 1), ("p1", 2), ("p2", 3)]
    again = top_n_per_group(df.repartition(3), ["g"], [F.col("c").desc(), F.col("id")], 3)
    assert rows(again, "id", "rank") == rows(out, "id", "rank")


def test_top_n_plans_window_group_limit(spark):
    df = spark.createDataFrame([("q", "a", 1)], "g string, id string, c long")
    out = top_n_per_group(df, ["g"], [F.col("c").desc(), F.col("id")], 10)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_argmax_set_ties(spark):
    df = spark.createDataFrame([("u", "b", 3), ("u", "a", 3), ("u", "c", 1), ("v", "z", 2)], "u string, k string, n long")
    assert rows(argmax_set(df, ["u"], "k", "n", "best")) == [("u", ["a", "b"]), ("v", ["z"])]
