"""Summarise a Spark event log: job and stage wall times.

Usage: python tools/eventlog.py <event-log-dir-or-file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def lines(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(f"{path}/**/events_*", recursive=True))
    for fn in files:
        raw = open(fn, "rb").read()
        if fn.endswith(".zstd"):
            reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
            chunks = []
            while chunk := reader.read(1 << 20):
                chunks.append(chunk)
            raw = b"".join(chunks)
        yield from raw.decode().splitlines()


def main() -> None:
    stages, jobs = {}, {}
    for line in lines(sys.argv[1]):
        try:
            e = json.loads(line)
        except json.JSONDecodeError:
            continue
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                      si["Completion Time"] - si["Submission Time"], si["Submission Time"])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    t0 = min(v[0] for v in jobs.values()) if jobs else 0
    for j in sorted(jobs):
        s, c, st = jobs[j]
        print(f"job {j:3d} +{s - t0:6d}ms dur {c - s:5d}ms stages {st}")
    for k in sorted(stages):
        name, n, dur, sub = stages[k]
        print(f"  stage {k:3d} +{sub - t0:6d}ms {dur:5d}ms tasks={n:3d} {name}")


if __name__ == "__main__":
    main()
