"""Benchmark: the whole warehouse, job by job, on the test tables.

Each job reads the Parquet layer its predecessor wrote and writes its own table (as the
warehouse runs in production). One warm-up run, then the median of BENCH_RUNS runs per job.
Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 5)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayfarer.plans import FIXTURE_PARAMS  # noqa: E402
from wayfarer.plans.pipeline import run_pipeline  # noqa: E402
from wayfarer.session import local_session, scratch_path  # noqa: E402
from wayfarer.sources.testdata import raw_pois, raw_trips  # noqa: E402

SHORT = {
    "ods_poi_dim": "ods_poi", "ods_user_travel_sequence": "ods_trips", "dwd_poi_info": "clean_poi",
    "dwd_user_travel_sequence_info": "clean_trips", "dws_user_travel_month": "user_month",
    "dws_attraction_travel_quarter": "attraction_quarter", "dws_city_travel_quarter": "city_quarter",
    "ads_user_portrait": "user_portrait", "ads_top50_attractions_last_year": "top_attractions",
    "ads_city_top10_last_year": "top_cities",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus, app="wayfarer-bench")
    per_job: dict[str, list[float]] = {}
    walls = []
    for r in range(runs + 1):
        timings: dict[str, float] = {}
        t0 = time.perf_counter()
        run_pipeline(spark, raw_pois(spark, sf_dir), raw_trips(spark, sf_dir), scratch_path(spark, "bench"),
                     FIXTURE_PARAMS, timings=timings)
        wall = time.perf_counter() - t0
        if r == 0:
            continue  # warm-up (JIT, file listing caches)
        walls.append(wall)
        for name, sec in timings.items():
            per_job.setdefault(SHORT[name], []).append(sec)
    queries = {k: round(statistics.median(v), 3) for k, v in per_job.items()}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "warehouse_pipeline_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(m.group(1)) if m else sf_dir,
        "runs": runs,
        "cpus": cpus,
        "wall_median": round(statistics.median(walls), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
