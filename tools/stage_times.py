"""Print stage durations from a Spark event log folder (``BENCH_EVENT_LOG``).

Usage: python tools/stage_times.py <event log folder> [top N]
Reads plain and zstd-compressed (Spark's default) rolling event logs.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as fh:
        if path.endswith(".zstd"):
            import zstandard

            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    stages = []
    for f in sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)):
        for line in _lines(f):
            if '"SparkListenerStageCompleted"' in line:
                info = json.loads(line)["Stage Info"]
                secs = (info["Completion Time"] - info["Submission Time"]) / 1000
                stages.append((secs, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:80]))
    print(f"{len(stages)} stages, {sum(s[0] for s in stages):.2f} s in total")
    for secs, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{secs:8.3f} s  stage {sid:4d}  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
