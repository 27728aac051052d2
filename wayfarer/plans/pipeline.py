"""Run the whole warehouse layer by layer, each job reading the tables the previous one wrote.

Writing every layer (like the original warehouse, whose jobs communicate only through
tables) cuts the lineage at each boundary: a lost executor only costs recomputing the
current job from stored inputs, and each job can be re-run on its own.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from wayfarer.operators.ledger import StepLedger, Tap, no_tap
from wayfarer.plans import jobs
from wayfarer.plans.params import REFERENCE_PARAMS, Params
from wayfarer.schemas import TABLES
from wayfarer.sources.files import exists, read_text, versions, write_text
from wayfarer.sources.tables import read_latest_year, read_table, read_year, write_layer


def table_paths(warehouse: str) -> dict[str, str]:
    names = ["ods_poi_dim", "ods_user_travel_sequence", "dwd_poi_info", "dwd_user_travel_sequence_info",
             "dws_user_travel_month", "dws_attraction_travel_quarter", "dws_city_travel_quarter",
             "ads_user_portrait", "ads_top50_attractions_last_year", "ads_city_top10_last_year"]
    return {n: f"{warehouse.rstrip('/')}/{n.split('_')[0]}/{n}" for n in names}


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a previous write of ``path`` finished (the committer's ``_SUCCESS`` marker)."""
    return exists(spark, f"{path}/_SUCCESS")


def _state_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/_state/{name}.json"


def read_state(spark: SparkSession, warehouse: str, name: str) -> dict | None:
    """What the last finished write of a table was made from: ``made_from`` and its own ``run``."""
    text = read_text(spark, _state_path(warehouse, name))
    try:
        return json.loads(text) if text else None
    except json.JSONDecodeError:  # cut off while it was written
        return None


def _write_state(spark: SparkSession, warehouse: str, name: str, made_from: str) -> None:
    write_text(spark, _state_path(warehouse, name), json.dumps({"made_from": made_from, "run": uuid.uuid4().hex}))


def fingerprint(name: str, params: Params, inputs: list[str]) -> str:
    """Identity of a table's content: parameters, declared schema and layout, identities of its inputs."""
    schema, parts = TABLES[name]
    text = json.dumps([repr(params), schema.json(), list(parts), inputs])
    return hashlib.sha256(text.encode()).hexdigest()


def raw_identity(df: DataFrame | None) -> list[str]:
    """Schema of a raw input and the files it is read from, with their lengths and times; rows that come from no
    file are the same only as the same rows of one session."""
    if df is None:
        return []
    files = df.inputFiles()
    return [df.schema.json(), *(versions(df.sparkSession, files) if files else [f"plan {df.semanticHash()}"])]


def read_declared(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored layer table; one whose columns or types are not the declared ones raises."""
    df = read_table(spark, path)
    want = {f.name: f.dataType.simpleString() for f in TABLES[name][0].fields}
    have = dict(df.dtypes)
    if have != want:
        raise ValueError(f"{path} is not the declared {name}: {sorted(set(have.items()) ^ set(want.items()))}")
    return df.select(*want)


# table -> tables it is made from
SOURCES = {
    "ods_poi_dim": (),
    "ods_user_travel_sequence": (),
    "dwd_poi_info": ("ods_poi_dim",),
    "dwd_user_travel_sequence_info": ("ods_user_travel_sequence",),
    "dws_user_travel_month": ("dwd_user_travel_sequence_info", "dwd_poi_info"),
    "dws_attraction_travel_quarter": ("dwd_user_travel_sequence_info", "dwd_poi_info"),
    "dws_city_travel_quarter": ("dws_attraction_travel_quarter",),
    "ads_user_portrait": ("dws_user_travel_month",),
    "ads_top50_attractions_last_year": ("dws_attraction_travel_quarter",),
    "ads_city_top10_last_year": ("dws_city_travel_quarter",),
}


def run_pipeline(spark: SparkSession, ods_poi: DataFrame | None, ods_trip: DataFrame | None, warehouse: str,
                 params: Params = REFERENCE_PARAMS, files_per_partition: int | None = None,
                 timings: dict[str, float] | None = None, resume: bool = False,
                 only: set[str] | None = None, ledger: StepLedger | None = None) -> dict[str, str]:
    """Write all ten tables under ``warehouse``; return their paths. ``timings`` (if given)
    receives the wall time of each job's write, ``ledger`` the rows in, kept by each cleaning step and out,
    counted while the jobs write. With ``resume``, a table is kept when its write
    completed with the same parameters and declared schema, from inputs that have not been written
    again since; everything else is redone. Raw inputs count as the same when their schema and files
    (names, lengths, times of modification) are. ``only`` restricts the run to the named tables (their
    inputs must already be written)."""
    p = table_paths(warehouse)
    raw = {"ods_poi_dim": ods_poi, "ods_user_travel_sequence": ods_trip}
    own_layout = files_per_partition is None

    def rd(name: str) -> DataFrame:
        return read_declared(spark, p[name], name)

    def of_year(name: str) -> DataFrame:
        if params.ranking_year is None:
            return read_latest_year(spark, p[name])
        return read_year(spark, p[name], params.ranking_year)

    # Each job, from its tap and the stack that releases at the end of its write what it keeps meanwhile.
    # A tap stands behind the columns that the job reads, so that the scan is pruned as without it.
    def poi(tap: Tap, held: ExitStack) -> DataFrame:
        return jobs.clean_poi(rd("ods_poi_dim"), params, tap)

    def trips(tap: Tap, held: ExitStack) -> DataFrame:
        return jobs.clean_trips(rd("ods_user_travel_sequence"), params, lay_out=own_layout, tap=tap)

    def user_month(tap: Tap, held: ExitStack) -> DataFrame:
        return held.enter_context(jobs.user_month_reused(rd("dwd_user_travel_sequence_info"), rd("dwd_poi_info"), params, tap))

    def attractions(tap: Tap, held: ExitStack) -> DataFrame:
        visits = rd("dwd_user_travel_sequence_info").select("poi_id", "travel_partners", "travel_year", "travel_month")
        return jobs.attraction_quarter(tap(visits, "visits"), rd("dwd_poi_info"), params)

    def cities(tap: Tap, held: ExitStack) -> DataFrame:
        # the city roll-up reads the (small) attraction table, not the visits a second time
        return jobs.city_quarter_from_attractions(rd("dws_attraction_travel_quarter"), params)

    def portrait(tap: Tap, held: ExitStack) -> DataFrame:
        months = rd("dws_user_travel_month").drop("travel_month", "first_trip_date")
        return jobs.user_portrait(tap(months, "user_months"), params)

    def top_attractions(tap: Tap, held: ExitStack) -> DataFrame:
        return jobs.top_attractions(tap(of_year("dws_attraction_travel_quarter"), "in_year"), params)

    def top_cities(tap: Tap, held: ExitStack) -> DataFrame:
        return jobs.top_cities(tap(of_year("dws_city_travel_quarter"), "in_year"), params)

    steps: dict[str, Callable[[Tap, ExitStack], DataFrame]] = {
        "ods_poi_dim": lambda tap, held: ods_poi, "ods_user_travel_sequence": lambda tap, held: ods_trip,
        "dwd_poi_info": poi, "dwd_user_travel_sequence_info": trips, "dws_user_travel_month": user_month,
        "dws_attraction_travel_quarter": attractions, "dws_city_travel_quarter": cities, "ads_user_portrait": portrait,
        "ads_top50_attractions_last_year": top_attractions, "ads_city_top10_last_year": top_cities}
    laid_out = {"dwd_user_travel_sequence_info"} if own_layout else set()
    for name, build in steps.items():
        if only is not None and name not in only:
            continue
        states = [read_state(spark, warehouse, t) for t in SOURCES[name]]
        inputs = raw_identity(raw.get(name)) + [s["run"] if s else "unknown" for s in states]
        made_from = fingerprint(name, params, inputs)
        if resume and "unknown" not in inputs and is_complete(spark, p[name]):
            state = read_state(spark, warehouse, name)
            if state and state["made_from"] == made_from:
                continue
        tap = ledger.tap(name) if ledger else no_tap
        t0 = time.perf_counter()
        with ExitStack() as held:
            out = tap(build(tap, held), "written", filters=name.startswith("ads_") and name != "ads_user_portrait")
            write_layer(out, name, p[name], files_per_partition=files_per_partition, laid_out=name in laid_out)
        if timings is not None:
            timings[name] = time.perf_counter() - t0
        if ledger:
            ledger.written(name)
        _write_state(spark, warehouse, name, made_from)
    return p
