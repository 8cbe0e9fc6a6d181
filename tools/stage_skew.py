"""Per-stage task-time skew from a Spark event log (no UI needed).

Run a job with ``spark.eventLog.enabled=true`` and ``spark.eventLog.dir`` set to
a scratch folder, then:

    python tools/stage_skew.py <event-log-dir>

Prints, for the stages with the most task time, the task count and the max
and median task duration; a max far above the median points at a hot
partition or a single-split input (how the one-row-group layout of the test
tables was found).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import statistics
import sys


def read_events(path: str):
    for f in glob.glob(f"{path}/**/*", recursive=True):
        if "events" not in f.rsplit("/", 1)[-1] and not f.endswith(".zstd"):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    tasks = collections.defaultdict(list)
    group = {}
    for ev in read_events(sys.argv[1]):
        kind = ev["Event"]
        if kind == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for s in ev["Stage IDs"]:
                group[s] = g
        elif kind == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    rows = [(group.get(s) or "-", s, len(t), max(t), statistics.median(t), sum(t)) for s, t in tasks.items()]
    for r in sorted(rows, key=lambda r: -r[5])[:20]:
        print("%-20s stage %4d  tasks %4d  max %6d ms  median %6d ms  total %7d ms" % r)


if __name__ == "__main__":
    main()
