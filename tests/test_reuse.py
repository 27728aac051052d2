"""Scoped persist, size-checked hints, and the user-month job that scans the visits once."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from wayfarer.operators.enrich import join_dim
from wayfarer.operators.reuse import NONE, broadcast_within, expected_bytes, persisted
from wayfarer.operators.rollup import fold_parts, kind_rollup
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.registry import Layers, canonical
from wayfarer.sources import write_layer


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    L, out = Layers(spark, SF_SMALL, P), tmp_path_factory.mktemp("reuse")
    write_layer(L.visits, "dwd_user_travel_sequence_info", f"{out}/visits")
    write_layer(L.dwd_poi, "dwd_poi_info", f"{out}/poi")
    return lambda name: spark.read.parquet(f"{out}/{name}")


def cached(spark):
    return spark._jsc.sc().getPersistentRDDs().size()


def test_rows_are_computed_once_and_released(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    before = cached(spark)
    df = spark.range(100).mapInPandas(count, "id long")
    with persisted(df) as kept:
        assert kept.count() == 100 and kept.where("id < 7").count() == 7
        assert seen.value == 100 and kept.storageLevel != NONE
    assert df.storageLevel == NONE and cached(spark) == before


def test_a_failure_releases_too(spark):
    df = spark.range(10).withColumn("x", F.lit(1))
    with pytest.raises(RuntimeError), persisted(df) as kept:
        kept.count()
        raise RuntimeError
    assert df.storageLevel == NONE


def test_who_persisted_first_releases(spark):
    df = spark.range(10).withColumn("y", F.lit(2))
    with persisted(df) as outer:
        with persisted(df) as inner:
            inner.count()
        assert outer.storageLevel != NONE
    assert df.storageLevel == NONE


def test_hints_are_checked(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    assert 0 < expected_bytes(small) < 100_000
    assert "broadcast" in broadcast_within(small, 1 << 20)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_within(small, 10)._jdf.queryExecution().logical().toString()
    fact = spark.range(50)
    off = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(off)
    spark.conf.set(off, "-1")
    try:
        assert "BroadcastHashJoin" in plan(join_dim(fact, small, ["id"], broadcast="hint", unique_key="allow"))
        assert "SortMergeJoin" in plan(join_dim(fact, small, ["id"], broadcast="hint", unique_key="allow", hint_bytes=10))
    finally:
        spark.conf.set(off, before)


def scans_of_visits(p):
    return [line for line in re.findall(r"FileScan parquet [^\n]*", p) if "trip_id" in line]


@pytest.mark.parametrize("bound", [1_000_000, 5])
def test_user_month_scans_the_visits_once(spark, stored, bound):
    params = P.with_(hot_user_month_visits=bound)
    want = {tuple(r) for r in canonical(jobs.user_month(stored("visits"), stored("poi"), P)).collect()}
    with jobs.user_month_reused(stored("visits"), stored("poi"), params) as df:
        p = plan(df)
        kept = p.count("InMemoryTableScan")
        if bound == 5:  # both routes read the kept parts; the plan that makes them is printed with each
            assert kept >= 2 and len(set(scans_of_visits(p))) == 1 and "REPARTITION_BY_COL" in p
        else:
            assert kept == 0 and len(scans_of_visits(p)) == 1
        assert "LeftAnti" not in p and "LeftSemi" not in p
        got = {tuple(r) for r in canonical(df).collect()}
    assert got == want and len(want) > 100
    assert cached(spark) == 0


def test_nothing_is_kept_after_a_failed_write(spark, stored):
    with pytest.raises(ZeroDivisionError), jobs.user_month_reused(
            stored("visits"), stored("poi"), P.with_(hot_user_month_visits=5)) as df:
        df.count()
        raise ZeroDivisionError
    assert cached(spark) == 0


def test_folded_parts_are_the_whole(spark, stored):
    v = stored("visits").join(stored("poi").select("poi_id", "city"), "poi_id", "left")
    keys = jobs.USER_MONTH
    whole = kind_rollup(v, keys, maps={"m": "city", "t": "trip_id"}, distinct_counts={"n": "trip_id"}, row_count="rows",
                        mins={"lo": "travel_date"}, maxs={"hi": "travel_date"})
    salted = v.withColumn("_s", F.pmod(F.xxhash64("poi_id"), F.lit(5)))
    parts = kind_rollup(salted, [*keys, "_s"], maps={"m": "city", "t": "trip_id"}, distinct_counts={"n": "trip_id"}, row_count="rows",
                        mins={"lo": "travel_date"}, maxs={"hi": "travel_date"})
    folded = fold_parts(parts, keys, maps=["m"], sums=["rows"], mins=["lo"], maxs=["hi"], distinct={"n": "t"})
    columns = [*keys, "m", "n", "rows", "lo", "hi"]
    assert rows(canonical(folded), *columns) == rows(canonical(whole), *columns)
