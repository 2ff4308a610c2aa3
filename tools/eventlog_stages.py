"""Summarise a Spark event log: slowest stages with task time, shuffle and
spill figures (no UI needed).

usage: python tools/eventlog_stages.py <event log file or dir> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(f):
    if f.endswith(".zstd"):
        import zstandard
        with open(f, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        return io.StringIO(data.decode("utf-8", "replace"))
    return open(f, errors="replace")


def _files(path):
    """Plain event-log files, also inside rolling (v2) event-log folders."""
    if not os.path.isdir(path):
        return [path]
    out = []
    for dirpath, _, files in os.walk(path):
        out += [os.path.join(dirpath, f) for f in sorted(files)
                if not f.startswith(".") and not f.startswith("appstatus")]
    return out


def main(argv):
    top = int(argv[2]) if len(argv) > 2 else 15
    stages = {}
    for f in _files(argv[1]):
        for line in _lines(f):
            if not line.strip():
                continue
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                m = ev.get("Task Metrics") or {}
                st = stages.setdefault(key, {"tasks": 0, "run_ms": 0, "shuffle_r": 0, "shuffle_w": 0, "spill": 0})
                st["tasks"] += 1
                st["run_ms"] += m.get("Executor Run Time", 0)
                st["shuffle_r"] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                    (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
                st["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                st["spill"] += m.get("Disk Bytes Spilled", 0)
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                key = (info["Stage ID"], info["Stage Attempt ID"])
                st = stages.setdefault(key, {"tasks": 0, "run_ms": 0, "shuffle_r": 0, "shuffle_w": 0, "spill": 0})
                st["name"] = info.get("Stage Name", "")[:60]
                st["wall_ms"] = (info.get("Completion Time") or 0) - (info.get("Submission Time") or 0)
    rows = sorted(stages.items(), key=lambda kv: -kv[1].get("wall_ms", 0))[:top]
    print(f"{'stage':>8} {'wall_ms':>8} {'task_ms':>8} {'tasks':>6} {'shuf_r':>10} {'shuf_w':>10} {'spill':>8}  name")
    for (sid, att), st in rows:
        print(f"{sid:>5}.{att:<2} {st.get('wall_ms', 0):>8} {st['run_ms']:>8} {st['tasks']:>6} "
              f"{st['shuffle_r']:>10} {st['shuffle_w']:>10} {st['spill']:>8}  {st.get('name', '')}")


if __name__ == "__main__":
    main(sys.argv)
