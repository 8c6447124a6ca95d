"""Summarise a Spark event log: per-stage wall time, tasks, shuffle bytes.

    python tools/stage_times.py <event-log-file>
"""

from __future__ import annotations

import json
import sys


def _lines(path: str):
    import os

    paths = [path]
    if os.path.isdir(path):  # rolling event log folder
        paths = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for p in paths:
        with open(p) as fh:
            yield from fh


def summarise(path: str) -> list[dict]:
    """Needs an uncompressed log (``spark.eventLog.compress=false``)."""
    stages = []
    for line in _lines(path):
        ev = json.loads(line)
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
        stages.append({
            "stage": info["Stage ID"],
            "name": info["Stage Name"][:60],
            "tasks": info["Number of Tasks"],
            "ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
            "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
            "shuffle_read": int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
            + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
            "spill": int(acc.get("internal.metrics.diskBytesSpilled", 0) or 0),
        })
    return stages


if __name__ == "__main__":
    rows = summarise(sys.argv[1])
    for r in rows:
        print(f"{r['stage']:4d} {r['ms']:7d}ms tasks={r['tasks']:4d} shw={r['shuffle_write']:>10d} "
              f"shr={r['shuffle_read']:>10d} spill={r['spill']} {r['name']}")
    print("total shuffle write", sum(r["shuffle_write"] for r in rows))
