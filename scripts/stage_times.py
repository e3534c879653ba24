"""Summarise a Spark event log: per job, its stages' wall time and task time.

Usage: python scripts/stage_times.py <event-log-file> [top_n]
"""

from __future__ import annotations

import io
import json
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 25
    stages = {}
    task_ms = defaultdict(int)
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                stages[info["Stage ID"]] = (
                    info.get("Stage Name", ""),
                    info.get("Number of Tasks", 0),
                    (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
                )
            elif kind == "SparkListenerTaskEnd":
                info = ev.get("Task Info", {})
                task_ms[ev["Stage ID"]] += (info.get("Finish Time", 0) or 0) - (info.get("Launch Time", 0) or 0)
    rows = sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]
    print(f"{'stage':>6} {'tasks':>6} {'wall_ms':>8} {'task_ms':>8}  name")
    for sid, (name, n, wall) in rows:
        print(f"{sid:>6} {n:>6} {wall:>8} {task_ms[sid]:>8}  {name[:70]}")


if __name__ == "__main__":
    main()
