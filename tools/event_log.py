"""Summarise a Spark event log: per-job wall time and the slowest stages.

usage: python tools/event_log.py <event log file or folder>
"""

import glob
import json
import os
import sys


def main():
    path = sys.argv[1]
    while os.path.isdir(path):   # folder of logs, or a rolling-log folder
        path = max(glob.glob(os.path.join(path, "*")), key=os.path.getmtime)
    lines = []
    folder = os.path.dirname(path)
    if os.path.basename(folder).startswith("eventlog_v2_"):
        for f in sorted(glob.glob(os.path.join(folder, "events_*"))):
            if f.endswith(".zstd"):
                import io

                import zstandard
                with open(f, "rb") as fh:
                    raw = zstandard.ZstdDecompressor().stream_reader(fh).read()
                lines += io.StringIO(raw.decode()).readlines()
            else:
                lines += open(f).readlines()
    else:
        lines = open(path).readlines()
    jobs, stages = {}, {}
    for line in lines:
        e = json.loads(line)
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, len(e.get("Stage IDs", []))]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"], si["Stage Name"][:70])
    total = 0
    for j, (s, t, n) in sorted(jobs.items()):
        d = (t - s) if t else -1
        total += max(d, 0)
        print(f"job {j:4d} {d:7d} ms  stages={n}")
    print(f"{len(jobs)} jobs, {total} ms in jobs")
    for sid, (d, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:15]:
        print(f"stage {sid:4d} {d:7d} ms tasks={n:4d} {name}")
    by_site = {}
    for d, n, name in stages.values():
        agg = by_site.setdefault(name, [0, 0])
        agg[0] += d
        agg[1] += 1
    print("-- stage time by call site")
    for name, (d, k) in sorted(by_site.items(), key=lambda kv: -kv[1][0])[:12]:
        print(f"{d:7d} ms in {k:4d} stages  {name}")


if __name__ == "__main__":
    main()
