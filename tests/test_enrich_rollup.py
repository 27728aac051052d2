import pytest
from pyspark.errors import PySparkException

from tests.conftest import rows
from wayfarer.operators import DuplicateKeyError, count_map, join_dim, kind_rollup, unique_by_key
from wayfarer.functions import map_text


@pytest.fixture
def fact(spark):
    return spark.createDataFrame([("u", "p1"), ("u", "p1"), ("u", "p9")], "u string, poi_id string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([("p1", "Zed", "c1"), ("p1", "Amy", "c2"), ("p2", "Bo", "c3")],
                                 "poi_id string, name string, city string")


def test_left_keeps_unknown_inner_drops(fact, dim):
    left = join_dim(fact, dim, ["poi_id"], how="left")
    inner = join_dim(fact, dim, ["poi_id"], how="inner")
    assert rows(left, "poi_id", "name") == [("p1", "Amy"), ("p1", "Amy"), ("p9", None)]
    assert rows(inner, "poi_id", "name") == [("p1", "Amy"), ("p1", "Amy")]


def test_unique_key_policies(fact, dim):
    assert join_dim(fact, dim, ["poi_id"], how="inner", unique_key="allow").count() == 4
    with pytest.raises(DuplicateKeyError):
        unique_by_key(dim, ["poi_id"], "error")
    assert unique_by_key(dim.filter("name != 'Zed'"), ["poi_id"], "error").count() == 2


@pytest.mark.parametrize("mode", ["auto", "never"])
def test_broadcast_modes_same_rows(fact, dim, mode):
    out = join_dim(fact, dim, ["poi_id"], how="left", broadcast=mode)
    assert rows(out, "poi_id", "city") == [("p1", "c2"), ("p1", "c2"), ("p9", None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    if mode == "never":
        assert "SortMergeJoin" in plan


def test_broadcast_is_checked_in_bytes(spark, tmp_path):
    fact = spark.range(1000).selectExpr("cast(id % 50 as string) AS poi_id")
    spark.range(50).selectExpr("cast(id as string) AS poi_id", "id AS v").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, join in (("10m", "BroadcastHashJoin"), ("1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out = join_dim(fact, dim, ["poi_id"], unique_key="allow")
            assert join in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(
        [("u", 1, "a", "x"), ("u", 1, "a", "y"), ("u", 1, None, "x"), ("u", 2, None, "x"), ("v", 1, "b", None)],
        "u string, m int, city string, trip string")


def test_count_map_null_policies(visits, spark):
    drop = count_map(visits, ["u", "m"], "city", "mp", null_key="drop")
    assert rows(drop.select("u", "m", map_text("mp"))) == [("u", 1, "a=2"), ("u", 2, ""), ("v", 1, "b=1")]
    label = count_map(visits, ["u", "m"], "city", "mp", null_key="?")
    assert rows(label.select("u", "m", map_text("mp"))) == [("u", 1, "?=1|a=2"), ("u", 2, "?=1"), ("v", 1, "b=1")]
    with pytest.raises(PySparkException):
        count_map(visits, ["u", "m"], "city", "mp", null_key="error").collect()


def test_kind_rollup_matches_separate_aggregates(visits):
    out = kind_rollup(visits, ["u", "m"], maps={"cities": "city"}, distinct_counts={"trips": "trip"},
                      row_count="n", mins={"lo": "trip"}, maxs={"hi": "trip"})
    got = rows(out.select("u", "m", map_text("cities"), "trips", "n", "lo", "hi"))
    assert got == [("u", 1, "a=2", 2, 3, "x", "y"), ("u", 2, "", 1, 1, "x", "x"), ("v", 1, "b=1", 0, 1, None, None)]


def test_kind_rollup_weights(spark):
    df = spark.createDataFrame([("c", "p1", "S", 3), ("c", "p2", "S", 2), ("c", "p2", "F", 1)],
                               "c string, poi string, partner string, w long")
    out = kind_rollup(df, ["c"], maps={"pm": "partner"}, distinct_counts={"pois": "poi"}, row_count="n", weight="w")
    assert rows(out.select("c", map_text("pm"), "pois", "n")) == [("c", "F=1|S=5", 2, 6)]
