"""Per job: the executed (final, adaptive) physical plan, reduced to the operators that matter at scale.

Each job reads its inputs from a layer written by the previous job (as in production), runs once
(noop sink) and its final plan is summarised: exchanges with their keys, join strategies,
aggregates, windows, scans with pruned schema and pushed / partition filters.

usage: python scripts/plan_report.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfarer.plans import FIXTURE_PARAMS as P  # noqa: E402
from wayfarer.plans import jobs  # noqa: E402
from wayfarer.plans.pipeline import run_pipeline  # noqa: E402
from wayfarer.session import local_session, scratch_path  # noqa: E402
from wayfarer.sources import read_table, read_year  # noqa: E402
from wayfarer.sources.testdata import raw_pois, raw_trips  # noqa: E402

KEEP = re.compile(r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastExchange|HashAggregate|"
                  r"SortAggregate|ObjectHashAggregate|WindowGroupLimit|Window |Generate|Scan parquet|FileScan|"
                  r"AQEShuffleRead|TakeOrderedAndProject|Sort \[)")


NOTES = """What to look for, job by job:

* **clean_poi / clean_trips**: one shuffle each (the de-dup), with partial aggregation before it; null-key
  filters are pushed into the Parquet scan and only the needed columns are read. The year-range filter sits
  under the de-dup aggregate.
* **user_month**: broadcast dimension (`BroadcastHashJoin LeftOuter`), `stack` expansion, then two
  aggregations with one exchange each; no joins between aggregates, no cache.
* **attraction_quarter**: exchange 1 = pre-aggregation per (POI, quarter, companions); the dimension is joined to
  the reduced rows; exchange 2 = hash by POI, reused by both the aggregate and the `lag` window.
* **user_portrait**: one hash by user pushed into the four union branches (the input has at most one row per
  user and month); both aggregations and the collect run without another exchange.
* **city_quarter_from_attractions** (used by the pipeline): reads the attraction table instead of the visits; the
  last two exchanges run on already-aggregated city rows.
* **top_attractions / top_cities**: `PartitionFilters` on the ranking year, `WindowGroupLimit` partial before the
  exchange and final after it.
"""


def _clean(line: str) -> str:
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    line = re.sub(r"\s+", " ", line)
    if line.startswith("FileScan"):
        cols = re.match(r"FileScan parquet (\[[^\]]*\])", line)
        parts = [f"FileScan parquet {cols.group(1) if cols else ''}"]
        for key in ("PartitionFilters", "PushedFilters"):
            m = re.search(key + r": (\[[^\]]*\])", line)
            if m and m.group(1) != "[]":
                parts.append(f"{key}: {m.group(1)}")
        m = re.search(r"ReadSchema: (struct<.*>)", line)
        if m:
            parts.append(f"ReadSchema: {m.group(1)}")
        return ", ".join(parts)
    return line[:240]


def summarise(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for raw in plan.splitlines():
        if KEEP.search(raw):
            indent = len(raw) - len(raw.lstrip(" :+-"))
            out.append("  " * (indent // 3) + _clean(raw.strip(" :+-")))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    wh = scratch_path(spark, "plans")
    paths = run_pipeline(spark, raw_pois(spark, sf_dir), raw_trips(spark, sf_dir), wh, P)
    rd = lambda n: read_table(spark, paths[n])
    visits, pois = rd("dwd_user_travel_sequence_info"), rd("dwd_poi_info")
    cases = [
        ("clean_poi", jobs.clean_poi(rd("ods_poi_dim"), P)),
        ("clean_trips", jobs.clean_trips(rd("ods_user_travel_sequence"), P)),
        ("user_month", jobs.user_month(visits, pois, P)),
        ("attraction_quarter", jobs.attraction_quarter(visits, pois, P)),
        ("city_quarter", jobs.city_quarter(visits, pois, P)),
        ("city_quarter_from_attractions",
         jobs.city_quarter_from_attractions(rd("dws_attraction_travel_quarter"), P)),
        ("user_portrait", jobs.user_portrait(rd("dws_user_travel_month"), P)),
        ("top_attractions", jobs.top_attractions(read_year(spark, paths["dws_attraction_travel_quarter"],
                                                           P.ranking_year), P)),
        ("top_cities", jobs.top_cities(read_year(spark, paths["dws_city_travel_quarter"], P.ranking_year), P)),
    ]
    print(f"# Executed plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `scripts/plan_report.py`: each job reads the layer its predecessor wrote; the final adaptive")
    print("plan is reduced to exchanges, joins, aggregates, windows and scans.\n")
    print(NOTES)
    for name, df in cases:
        lines = summarise(df)
        n_ex = sum(1 for line in lines if re.match(r"\s*Exchange (hash|range|Single|Round)", line))
        print(f"## {name}\n\nshuffle exchanges: {n_ex}\n\n```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
