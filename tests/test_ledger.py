"""Row counts of a run's steps, taken while they write."""

from tests.conftest import SF_SMALL
from wayfarer.operators.ledger import StepLedger
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans import jobs
from wayfarer.plans.pipeline import run_pipeline, table_paths
from wayfarer.plans.registry import Layers
from wayfarer.sources.testdata import raw_pois, raw_trips


def run(spark, path, group, **kw):
    """The number of jobs of a run."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run_pipeline(spark, raw_pois(spark, SF_SMALL), raw_trips(spark, SF_SMALL), path, P, **kw)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_need_no_job_and_are_those_of_the_tables(spark, tmp_path):
    plain = run(spark, str(tmp_path / "plain"), "plain")
    ledger = StepLedger()
    assert run(spark, str(tmp_path / "counted"), "counted", ledger=ledger) == plain
    paths = table_paths(str(tmp_path / "counted"))
    written = {c.step: c.row_cnt for c in ledger.rows if c.point == "written"}
    assert written == {name: spark.read.parquet(p).count() for name, p in paths.items()}
    trips = [(c.point, c.row_cnt, c.dropped_cnt) for c in ledger.rows if c.step == "dwd_user_travel_sequence_info"]
    L = Layers(spark, SF_SMALL, P)
    n = [L.ods_trip.count(), L.parsed.count(), None, jobs.dedupe_trips(L.parsed, P).count()]
    assert [t[0] for t in trips] == ["read", "with_keys", "in_years", "unique", "visits", "written"]
    assert trips[0][1] == n[0] and trips[1][1:] == (n[1], n[0] - n[1]) and trips[3][1] == n[3]
    assert all(d is None or d >= 0 for _, _, d in trips) and trips[4][2] is None


def test_kept_steps_have_no_counts(spark, tmp_path):
    path = str(tmp_path / "w")
    run(spark, path, "first")
    ledger = StepLedger()
    run(spark, path, "second", ledger=ledger, resume=True)
    assert ledger.rows == []


def test_a_tap_counts_what_passes(spark):
    ledger = StepLedger()
    tap = ledger.tap("s")
    df = tap(tap(spark.range(10), "all").where("id % 3 = 0"), "thirds")
    df = tap(tap(df.selectExpr("explode(sequence(0, 1)) AS k", "id"), "twice", filters=False), "same")
    df.write.format("noop").mode("overwrite").save()
    ledger.written("s")
    assert [(c.point, c.row_cnt, c.dropped_cnt) for c in ledger.rows] == [
        ("all", 10, None), ("thirds", 4, 6), ("twice", 8, None), ("same", 8, 0)]
    assert [r["point"] for r in ledger.table(spark).orderBy("point_no").collect()] == ["all", "thirds", "twice", "same"]


def test_jobs_without_a_tap_have_none(spark):
    L = Layers(spark, SF_SMALL, P)
    for df in (L.dwd_poi, L.visits):
        assert "CollectMetrics" not in df._jdf.queryExecution().logical().toString()
