"""Command line: run the warehouse (or some of its tables) with ``spark-submit``.

    spark-submit wayfarer/__main__.py --poi-csv POIs.csv --trip-csv Visit_Sequences.csv \\
        --warehouse hdfs:///warehouse/travel [--resume] [--only dws_user_travel_month ...] \\
        [--year-min 2011 --year-max 2022 --ranking-year 2021 --reference-date 2022-01-01]

The session comes from ``spark-submit`` (master, resources, ``spark.checkpoint.dir``); nothing
here picks a master. Without ``--poi-csv`` / ``--trip-csv`` the raw tables must already be
written in the warehouse (use ``--only`` for the later tables).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from wayfarer.plans import REFERENCE_PARAMS, jobs  # noqa: E402
from wayfarer.plans.pipeline import run_pipeline, table_paths  # noqa: E402


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="wayfarer", description=__doc__.split("\n")[0])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--poi-csv")
    ap.add_argument("--trip-csv")
    ap.add_argument("--resume", action="store_true", help="keep tables whose write already completed")
    ap.add_argument("--only", nargs="*", choices=sorted(table_paths("/").keys()), help="tables to (re)write")
    d = REFERENCE_PARAMS
    ap.add_argument("--year-min", type=int, default=d.year_min)
    ap.add_argument("--year-max", type=int, default=d.year_max)
    ap.add_argument("--ranking-year", type=int, default=d.ranking_year)
    ap.add_argument("--reference-date", default=d.reference_date)
    ap.add_argument("--top-attractions", type=int, default=d.top_attractions)
    ap.add_argument("--top-cities", type=int, default=d.top_cities)
    ap.add_argument("--growth-gap", choices=["bridge", "strict"], default=d.growth_gap)
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> dict[str, str]:
    a = parse_args(argv)
    params = REFERENCE_PARAMS.with_(
        year_min=a.year_min, year_max=a.year_max, ranking_year=a.ranking_year, reference_date=a.reference_date,
        top_attractions=a.top_attractions, top_cities=a.top_cities, growth_gap=a.growth_gap)
    spark = SparkSession.builder.appName("wayfarer").getOrCreate()
    poi = trip = None
    if a.poi_csv or a.trip_csv:
        if not (a.poi_csv and a.trip_csv):
            raise SystemExit("--poi-csv and --trip-csv go together")
        poi, trip = jobs.load_ods(spark, a.poi_csv, a.trip_csv)
    elif not a.only or {"ods_poi_dim", "ods_user_travel_sequence"} & set(a.only):
        raise SystemExit("raw CSVs are needed unless --only names later tables")
    paths = run_pipeline(spark, poi, trip, a.warehouse, params, resume=a.resume,
                         only=set(a.only) if a.only else None)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
