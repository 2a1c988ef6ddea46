"""Print per-stage wall times from a Spark event log directory.

    python tools/stage_times.py <eventlog dir or file>
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
        with open(path) as fh:
            yield from fh


def main(target: str) -> None:
    files = sorted(glob.glob(os.path.join(target, "**", "events_*"), recursive=True)) if os.path.isdir(target) else [target]
    stages, sql = {}, []
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                scopes = []
                for rdd in si.get("RDD Info", []):
                    sc = rdd.get("Scope")
                    if sc:
                        name = json.loads(sc).get("name", "")
                        if name and name not in scopes:
                            scopes.append(name)
                stages[si["Stage ID"]] = ((si["Completion Time"] - si["Submission Time"]) / 1000,
                                          si["Number of Tasks"], " | ".join(scopes)[:110] or si["Stage Name"][:60],
                                          si["Submission Time"])
            elif ev.endswith("SparkListenerSQLExecutionStart"):
                sql.append((e["time"], e["executionId"]))
    t0 = min(v[3] for v in stages.values())
    for t, i in sql:
        print(f"sql {i} at +{(t - t0) / 1000:.2f}s")
    for k, (dur, n, name, start) in sorted(stages.items(), key=lambda kv: kv[1][3]):
        print(f"stage {k:4d} +{(start - t0) / 1000:7.2f}s {dur:6.2f}s tasks={n:4d} {name}")


if __name__ == "__main__":
    main(sys.argv[1])
