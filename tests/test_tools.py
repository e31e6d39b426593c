"""The event-log summary attributes jobs to queries by bench's time windows."""

import json
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from eventlog_summary import summarise  # noqa: E402


def test_eventlog_summary_attributes_by_window(tmp_path):
    events = [
        {"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 1500, "Stage IDs": [10]},
        {"Event": "SparkListenerJobStart", "Job ID": 2, "Submission Time": 2500, "Stage IDs": [11]},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 10, "Task Metrics": {
            "Executor Run Time": 2000, "Shuffle Write Metrics": {"Shuffle Bytes Written": 3_000_000}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 10, "Task Metrics": {"Executor Run Time": 1000}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 11, "Task Metrics": {
            "Executor Run Time": 500, "Output Metrics": {"Bytes Written": 1_000_000}}},
    ]
    (tmp_path / "events_1_app").write_text("\n".join(json.dumps(e) for e in events) + "\n")
    (tmp_path / "windows.json").write_text(json.dumps({"q1": [[1000, 2000]], "q2": [[2400, 3000]]}))
    totals = summarise(str(tmp_path))
    assert totals["q1"]["tasks"] == 2 and totals["q1"]["task_sec"] == 3.0
    assert totals["q1"]["shuffle_write_mb"] == 3.0
    assert totals["q2"]["output_mb"] == 1.0 and totals["q2"]["tasks"] == 1
