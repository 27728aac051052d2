"""Summarise a Spark event log (job / stage wall times) written to a scratch folder.

usage: python scripts/eventlog_summary.py <eventlog dir or file> [last_n_jobs]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main() -> None:
    path = sys.argv[1]
    last = int(sys.argv[2]) if len(sys.argv) > 2 else 30
    stages, jobs, sqlx, tasks = {}, {}, {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            t = tasks.setdefault(e["Stage ID"], {"run": 0, "gc": 0, "spill": 0, "sw": 0, "sr": 0, "max": 0, "n": 0})
            t["run"] += m.get("Executor Run Time", 0)
            t["gc"] += m.get("JVM GC Time", 0)
            t["spill"] += m.get("Disk Bytes Spilled", 0)
            t["sw"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            rd = m.get("Shuffle Read Metrics") or {}
            t["sr"] += rd.get("Remote Bytes Read", 0) + rd.get("Local Bytes Read", 0)
            t["max"] = max(t["max"], m.get("Executor Run Time", 0))
            t["n"] += 1
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"],
                                      si["Completion Time"] - si["Submission Time"])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], e.get("Properties", {}).get("spark.sql.execution.id")]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]].append(e["Completion Time"])
        elif ev.endswith("SparkListenerSQLExecutionStart"):
            sqlx[e["executionId"]] = [e["time"], e["description"][:50]]
        elif ev.endswith("SparkListenerSQLExecutionEnd"):
            sqlx[e["executionId"]].append(e["time"])
    for k, v in sorted(sqlx.items()):
        if len(v) == 3:
            print(f"sql {k:4d} {v[2] - v[0]:6d} ms  {v[1]}")
    for j, v in sorted(jobs.items())[-last:]:
        if len(v) < 4:
            continue
        s, st, ex, en = v
        print(f"job {j:4d} sql={ex} t={s % 1000000:7d} dur={en - s:5d} ms")
        for i in st:
            if i in stages:
                t = tasks.get(i, {})
                print(f"    stage {i:4d} tasks={stages[i][1]:4d} wall={stages[i][2]:5d} ms run_sum={t.get('run', 0):6d} "
                      f"max_task={t.get('max', 0):5d} gc={t.get('gc', 0):5d} spill={t.get('spill', 0)} "
                      f"shuffle_w={t.get('sw', 0) >> 10}K shuffle_r={t.get('sr', 0) >> 10}K")


if __name__ == "__main__":
    main()
