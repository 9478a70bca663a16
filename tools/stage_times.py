"""Summarise stage times from a Spark event log folder (no UI needed).

Usage: python tools/stage_times.py <event_log_dir> [top_n]
Prints the slowest stages: id, name, tasks, wall ms, summed task run time ms.
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    """Lines of one event log file, zstd-compressed (Spark's default) or plain."""
    import io

    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    elif not path.endswith((".lz4", ".snappy", ".lzf")):
        with open(path, encoding="utf-8") as fh:
            yield from fh


def stages(path: str) -> list[dict]:
    files = [f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(f)]
    out, run_ms = [], {}
    for f in files:
        for line in _lines(f):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    key = (ev["Stage ID"], ev["Stage Attempt ID"])
                    run_ms[key] = run_ms.get(key, 0) + (ev.get("Task Metrics") or {}).get("Executor Run Time", 0)
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    sub, done = info.get("Submission Time"), info.get("Completion Time")
                    out.append({"stage": info["Stage ID"], "attempt": info["Stage Attempt ID"],
                                "name": info["Stage Name"][:60], "tasks": info["Number of Tasks"],
                                "wall_ms": (done - sub) if sub and done else None})
    for s in out:
        s["task_ms"] = run_ms.get((s["stage"], s["attempt"]), 0)
    return out


def main() -> None:
    rows = sorted(stages(sys.argv[1]), key=lambda s: -(s["wall_ms"] or 0))
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    for s in rows[:top]:
        print(f"{s['stage']:>5} {s['tasks']:>5} tasks {s['wall_ms'] or 0:>7} ms wall {s['task_ms']:>8} ms tasks  {s['name']}")


if __name__ == "__main__":
    main()
