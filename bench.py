"""Benchmark: run the catalog queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed with a no-op sink (the whole plan runs, nothing is
collected), once to warm up and then $BENCH_REPS times; the median is
reported. ``BENCH_EVENT_LOG=<folder>`` also writes Spark's event log there
(stage and task times). Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from laminar.queries import QUERIES  # noqa: E402
from laminar.session import build_session  # noqa: E402

HEADLINE = ("datamart", "corr_by_group", "latest_batch", "nested_explode")


WINDOWS: dict[str, list[tuple[int, int]]] = {}


def run_once(spark, fn, sf_dir, name: str = "") -> float:
    spark.catalog.clearCache()  # every run recomputes its cached per-state sides
    start_ms = int(time.time() * 1000)
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    WINDOWS.setdefault(name, []).append((start_ms, int(time.time() * 1000)))
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")}
    event_log = os.environ.get("BENCH_EVENT_LOG")   # a scratch folder for stage/task timings
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(f"local[{cpus}]", int(cpus), app_name="laminar-bench", extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    names = only or list(HEADLINE) + [q for q in QUERIES if q not in HEADLINE]
    timings = {}
    for name in names:
        run_once(spark, QUERIES[name], sf_dir, name)
        timings[name] = round(statistics.median(run_once(spark, QUERIES[name], sf_dir, name)
                                                for _ in range(reps)), 3)
    if event_log:   # query windows, to attribute event-log jobs to queries by time
        with open(os.path.join(event_log, "windows.json"), "w", encoding="utf-8") as fh:
            json.dump(WINDOWS, fh)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum of median warm query seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "headline": {q: timings[q] for q in HEADLINE if q in timings},
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": int(cpus),
        "reps": reps,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
