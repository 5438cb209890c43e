"""Summarise stage and task times from a Spark event log folder:

    BENCH_EVENT_LOG=$(mktemp -d) python bench.py; python tools/event_log_summary.py <that folder>
"""
import json, sys, glob, collections
files = glob.glob(sys.argv[1] + "/*/*") + glob.glob(sys.argv[1] + "/*")
stages, tasks = {}, collections.defaultdict(list)
for f in files:
    import io, os, zstandard
    if os.path.isdir(f) or "appstatus" in f:
        continue
    raw = open(f, "rb").read()
    if f.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    for line in raw.decode().splitlines():
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages[si["Stage ID"]] = (dur, si["Number of Tasks"], si["Stage Name"][:60])
        elif ev == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            tasks[e["Stage ID"]].append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
print("stages:", len(stages), "total stage sec:", round(sum(d for d, _, _ in stages.values()), 1))
for sid, (d, n, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:10]:
    t = tasks.get(sid, [0])
    print(f"stage {sid:4d} {d:6.2f}s tasks={n:3d} max_task={max(t):.2f}s median_task={sorted(t)[len(t)//2]:.2f}s  {name}")
