"""Summarise a Spark event log: SQL executions with duration, driver gap and stages.

Usage: python tools/eventlog_summary.py <eventLog.dir> [job-description-filter]
Run the job with spark.eventLog.enabled=true and spark.eventLog.dir=<a scratch
folder>; set sc.setJobDescription(...) around the part to inspect.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    want = sys.argv[2] if len(sys.argv) > 2 else ""
    app = sorted(glob.glob(os.path.join(root, "*")), key=os.path.getmtime)[-1]
    files = sorted(glob.glob(os.path.join(app, "events_*"))) if os.path.isdir(app) else [app]
    jobs, sqls, stages = {}, {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {})
                jobs[e["Job ID"]] = {"stages": [s["Stage ID"] for s in e["Stage Infos"]],
                                     "sql": props.get("spark.sql.execution.id"),
                                     "desc": props.get("spark.job.description", "")}
            elif ev.endswith("SQLExecutionStart"):
                sqls[e["executionId"]] = {"start": e["time"], "desc": e.get("description", "")[:40]}
            elif ev.endswith("SQLExecutionEnd"):
                sqls[e["executionId"]]["end"] = e["time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                          si["Number of Tasks"])
    prev = None
    for i in sorted(sqls):
        v = sqls[i]
        js = [j for j, x in jobs.items() if x["sql"] == str(i)]
        desc = jobs[js[0]]["desc"] if js else ""
        end = v.get("end", v["start"])
        if want and want not in (desc or ""):
            prev = end
            continue
        gap = v["start"] - prev if prev else 0
        st = [stages[s] for j in js for s in jobs[j]["stages"] if s in stages]
        print(f"sql {i}: {end - v['start']} ms, driver gap {gap} ms, stages (ms, tasks) {st} {v['desc']}")
        prev = end


if __name__ == "__main__":
    main()
