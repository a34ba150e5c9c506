"""Writes SHUFFLE.md: bytes read, shuffled and tasks run per catalogue query.

Each query runs once through the ``noop`` sink under its own job
description, with Spark's event log written to a fresh scratch folder; the
log is then summed per query.

usage: python tools/shuffle_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cmdeval.plans import QUERIES  # noqa: E402
from cmdeval.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "SHUFFLE.md")
    log_dir = os.environ.get("SHUFFLE_LOG_DIR")  # re-read an earlier run's log
    if not log_dir:
        log_dir = tempfile.mkdtemp(prefix="cmdeval-eventlog-")
        spark = local_session(8, 16, app="cmdeval-shuffle", extra={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false"})
        spark.sparkContext.setLogLevel("ERROR")
        for name, fn in QUERIES.items():
            spark.sparkContext.setJobDescription(name)
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.stop()

    stage_query: dict[int, str] = {}
    totals = defaultdict(lambda: defaultdict(int))
    files = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and "appstatus" not in os.path.basename(p))
    for path in files:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    q = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if q:
                            stage_query[sid] = q
                elif kind == "SparkListenerTaskEnd":
                    q = stage_query.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not q:
                        continue
                    t = totals[q]
                    t["tasks"] += 1
                    w = m.get("Shuffle Write Metrics") or {}
                    t["shuffle_bytes"] += w.get("Shuffle Bytes Written", 0)
                    t["shuffle_records"] += w.get("Shuffle Records Written", 0)
    mb = 1024 * 1024
    lines = ["# Shuffle volume per query", "",
             f"`tools/shuffle_report.py` on `{sf_dir}`, local[8], 16 shuffle partitions, AQE on.",
             "Shuffle = bytes and records written to shuffle files. Streaming micro-batches",
             "run on their own thread without the job description, so only the batch part of",
             "the stream queries is counted.", "",
             "| query | shuffle MB | shuffle records | tasks |", "|---|---|---|---|"]
    for name in QUERIES:
        t = totals.get(name, {})
        lines.append(f"| `{name}` | {t.get('shuffle_bytes', 0) / mb:.1f} | "
                     f"{t.get('shuffle_records', 0):,} | {t.get('tasks', 0)} |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
