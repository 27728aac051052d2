"""A resumed pipeline keeps what is still right and redoes the rest."""

import pytest

from tests.conftest import SF_SMALL
from wayfarer.plans import FIXTURE_PARAMS as P
from wayfarer.plans.pipeline import read_declared, read_state, run_pipeline, table_paths
from wayfarer.sources.testdata import raw_pois, raw_trips


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("resume"))
    run(spark, path)
    return path


def run(spark, path, params=P, **kw):
    timings = {}
    run_pipeline(spark, raw_pois(spark, SF_SMALL), raw_trips(spark, SF_SMALL), path, params, timings=timings, **kw)
    return set(timings)


def test_nothing_is_redone_without_a_change(spark, warehouse):
    assert run(spark, warehouse, resume=True) == set()


def test_other_parameters_are_not_taken_for_done(spark, warehouse):
    redone = run(spark, warehouse, P.with_(ranking_year=1999), resume=True)
    assert {"ads_top50_attractions_last_year", "ads_city_top10_last_year"} <= redone
    paths = table_paths(warehouse)
    years = {r[0][:4] for r in spark.read.parquet(paths["ads_city_top10_last_year"]).select("year_quarter").collect()}
    assert years == {"1999"}


def test_a_redone_input_redoes_what_is_made_from_it(spark, warehouse):
    run(spark, warehouse, resume=True)
    before = read_state(spark, warehouse, "dws_user_travel_month")
    assert run(spark, warehouse, only={"dwd_poi_info"}) == {"dwd_poi_info"}
    redone = run(spark, warehouse, resume=True)
    assert redone == {"dws_user_travel_month", "dws_attraction_travel_quarter", "dws_city_travel_quarter", "ads_user_portrait",
                      "ads_top50_attractions_last_year", "ads_city_top10_last_year"}
    assert read_state(spark, warehouse, "dws_user_travel_month") != before


def test_stored_tables_must_be_as_declared(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "n")], "poi_id string, name string").write.parquet(path)
    with pytest.raises(ValueError, match="declared"):
        read_declared(spark, path, "dwd_poi_info")


def test_an_overwritten_raw_file_is_not_taken_for_the_old_one(spark, tmp_path):
    import shutil

    from wayfarer.sources.csv_load import POI_CSV_COLUMNS, read_poi_csv, write_source_csv
    raw, path = tmp_path / "raw", str(tmp_path / "w")
    write_source_csv(raw_pois(spark, SF_SMALL).coalesce(1), str(raw), POI_CSV_COLUMNS)
    file = next(f for f in raw.iterdir() if f.suffix == ".csv")

    def redone():
        timings = {}
        run_pipeline(spark, read_poi_csv(spark, str(raw)), raw_trips(spark, SF_SMALL), path, P, timings=timings, resume=True,
                     only={"ods_poi_dim", "dwd_poi_info"})
        return set(timings)

    assert redone() == {"ods_poi_dim", "dwd_poi_info"} and redone() == set()
    lines = file.read_text().splitlines(keepends=True)
    shutil.copy(file, tmp_path / "copy.csv")
    file.write_text("".join(lines[:-1]))  # under its own name
    (raw / f".{file.name}.crc").unlink(missing_ok=True)
    assert redone() == {"ods_poi_dim", "dwd_poi_info"}
    assert spark.read.parquet(table_paths(path)["ods_poi_dim"]).count() == len(lines) - 2


def test_rows_that_come_from_no_file_are_known_by_their_plan(spark):
    from wayfarer.plans.pipeline import raw_identity
    one, other = (spark.createDataFrame([(x,)], "poi_id string") for x in "12")
    assert raw_identity(one) == raw_identity(one) != raw_identity(other) and raw_identity(None) == []
