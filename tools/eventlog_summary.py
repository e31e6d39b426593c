"""Per-query input, shuffle and task time from a Spark event log written by bench.py.

Usage: python tools/eventlog_summary.py <event log file or folder>
Jobs are attributed to queries by their submission time, using the query
windows bench.py writes next to the log (``windows.json``); bench.py runs
queries one after another, so the attribution is exact. Totals cover the
warm-up run and every timed run.
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(file: str):
    """Lines of a (possibly zstd-compressed, as Spark 4 writes them) event log file."""
    if file.endswith(".zstd"):
        import zstandard
        with open(file, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(file, encoding="utf-8") as fh:
            yield from fh


def summarise(path: str) -> dict[str, dict[str, float]]:
    files = [os.path.join(path, f) for f in sorted(os.listdir(path))] if os.path.isdir(path) else [path]
    stage_group: dict[int, str] = {}
    windows_file = os.path.join(path if os.path.isdir(path) else os.path.dirname(path), "windows.json")
    windows = []
    if os.path.exists(windows_file):
        with open(windows_file, encoding="utf-8") as fh:
            windows = [(a, b, q) for q, spans in json.load(fh).items() for a, b in spans]

    def query_at(ms: int) -> str:
        return next((q for a, b, q in windows if a <= ms <= b), "(between queries)")

    totals: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for file in files:
        if os.path.isdir(file):
            files.extend(os.path.join(file, f) for f in sorted(os.listdir(file)))
            continue
        if os.path.basename(file).startswith((".", "appstatus")) or file.endswith(".json"):
            continue
        for line in _lines(file):
            if line.strip():
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = query_at(ev.get("Submission Time", 0))
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    t = totals[stage_group.get(ev.get("Stage ID"), "(between queries)")]
                    t["input_mb"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0) / 1e6
                    t["shuffle_write_mb"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0) / 1e6
                    t["output_mb"] += (m.get("Output Metrics") or {}).get("Bytes Written", 0) / 1e6
                    t["task_sec"] += m.get("Executor Run Time", 0) / 1e3
                    t["tasks"] += 1
    return totals


def main(path: str) -> None:
    totals = summarise(path)
    print("| query | input MB | shuffle write MB | output MB | task sec | tasks |")
    print("| --- | ---: | ---: | ---: | ---: | ---: |")
    for q, t in sorted(totals.items()):
        print(f"| `{q}` | {t['input_mb']:.1f} | {t['shuffle_write_mb']:.2f} | {t['output_mb']:.1f} "
              f"| {t['task_sec']:.1f} | {int(t['tasks'])} |")


if __name__ == "__main__":
    main(sys.argv[1])
