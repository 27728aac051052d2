"""User-months counted in their row: the same rows as the (kind, key) roll-up."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer.operators.rollup import kind_rollup, row_rollup
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.registry import Layers, canonical
from wayfarer.sources import write_layer

VISITS = [("u", 1, "t1", "A", "x", 5), ("u", 1, "t1", "A", None, 5), ("u", 1, "t2", None, "x", 7), ("u", 2, "t3", "B", "y", 9),
          ("v", 1, None, None, None, 3), ("v", 1, "t1", "A", "x", 4)]


@pytest.mark.parametrize("null_key", ["drop", "none"])
def test_row_rollup_is_the_roll_up(spark, null_key):
    df = spark.createDataFrame(VISITS, "u string, m int, trip string, city string, partner string, day int")
    given = {"maps": {"cities": "city", "partners": "partner"}, "distinct_counts": {"trips": "trip"}, "row_count": "n",
             "mins": {"lo": "day"}, "maxs": {"hi": "day"}, "null_key": null_key}
    want = kind_rollup(df, ["u", "m"], **given)
    got = row_rollup(df, ["u", "m"], **given)
    assert got.columns == ["u", "m", "cities", "partners", "trips", "n", "lo", "hi"] and got.dtypes == want.select(*got.columns).dtypes
    assert rows(canonical(got)) == rows(canonical(want), *got.columns)
    counted = df.withColumn("w", F.lit(3).cast("bigint"))
    weighted = {**given, "weight": "w"}
    assert rows(canonical(row_rollup(counted, ["u", "m"], **weighted))) == rows(canonical(kind_rollup(counted, ["u", "m"], **weighted)), *got.columns)


def test_null_key_error(spark):
    df = spark.createDataFrame(VISITS, "u string, m int, trip string, city string, partner string, day int")
    with pytest.raises(Exception, match="(?i)null"):
        row_rollup(df, ["u"], maps={"c": "city"}, distinct_counts={}, row_count="n", null_key="error").collect()


def test_user_months_are_not_expanded(spark, tmp_path):
    """Visits are sorted once into the row of their user-month; only hot ones become (kind, key) rows."""
    L = Layers(spark, SF_SMALL, P)
    write_layer(L.visits, "dwd_user_travel_sequence_info", f"{tmp_path}/v")
    write_layer(L.dwd_poi, "dwd_poi_info", f"{tmp_path}/p")
    visits, poi = (spark.read.parquet(f"{tmp_path}/{n}") for n in "vp")
    p = plan(jobs.user_month(visits, poi, P))
    assert p.count("Generate stack") == 1 and p.count("REPARTITION_BY_COL") == 1
    assert jobs.hot_bound(P) == jobs.ROW_VISITS and jobs.hot_bound(P.with_(hot_user_month_visits=9)) == 9
    with jobs.user_month_reused(visits, poi, P) as df:
        assert "Generate stack" not in plan(df)


def test_a_visit_repeated_often(spark, tmp_path):
    """Equal visits share a salt: they are counted before they meet in a row."""
    L = Layers(spark, SF_SMALL, P)
    write_layer(L.dwd_poi, "dwd_poi_info", f"{tmp_path}/p")
    poi = spark.read.parquet(f"{tmp_path}/p")
    again = F.when(F.col("blog_id").cast("bigint") % 10 == 0, F.array_repeat(F.lit(1), 300)).otherwise(F.array(F.lit(1)))
    write_layer(L.visits.withColumn("_c", F.explode(again)).drop("_c"), "dwd_user_travel_sequence_info", f"{tmp_path}/v")
    visits = spark.read.parquet(f"{tmp_path}/v")
    want = rows(canonical(jobs.user_month(visits, poi, P)))
    assert max(r[1] for r in rows(canonical(jobs.user_month(visits, poi, P)), "blog_id", "total_spot_cnt")) >= 300
    with jobs.user_month_reused(visits, poi, P.with_(hot_user_month_visits=50)) as df:
        assert rows(canonical(df)) == want
        assert "count(1)" in plan(df)
    assert rows(canonical(jobs.user_month(visits, poi, P.with_(hot_user_month_visits=50)))) == want
