"""Writes PLANS.md: the physical-plan shape of every catalogue query.

Plans are taken with broadcast joins and adaptive execution off, i.e. the
shape a cluster gets when no side is small. Streaming queries are skipped
(their plans are per micro-batch).

usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cmdeval.plans import QUERIES  # noqa: E402
from cmdeval.session import local_session  # noqa: E402

SKIP = {"json_report", "json_summary", "json_models", "train_log_records"}
NODES = ("Exchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "CartesianProduct",
         "BroadcastNestedLoopJoin", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "Window", "WindowGroupLimit", "TakeOrderedAndProject", "Generate", "MapInPandas",
         "MapInArrow", "ArrowEvalPython", "BatchEvalPython")


def shape(plan: str) -> dict:
    counts = {}
    for line in plan.split("\n"):
        body = line.strip().lstrip(":+- *()0123456789")
        for n in NODES:
            if body.startswith(n + " ") or body.startswith(n + "(") or body == n:
                counts[n] = counts.get(n, 0) + 1
    exchanges = re.findall(r"Exchange (\w+)", plan)
    reads = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)) - {"[]"})
    return {"counts": counts, "exchanges": exchanges, "reads": reads, "pushed": pushed}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    lines = ["# Physical plan shapes", "",
             "Generated by `tools/plan_report.py` with broadcast joins and AQE off (the shape a",
             "cluster gets when no side is small).",
             "", "| query | exchanges | joins / aggregates / other | Python |", "|---|---|---|---|"]
    details = []
    for name, fn in QUERIES.items():
        if name in SKIP or name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        c = s["counts"]
        other = ", ".join(f"{k}×{v}" for k, v in c.items() if k not in ("Exchange",) and "Python" not in k
                          and k not in ("MapInPandas", "MapInArrow"))
        py = ", ".join(f"{k}×{v}" for k, v in c.items() if "Python" in k or k in ("MapInPandas", "MapInArrow")) or "none"
        lines.append(f"| `{name}` | {', '.join(s['exchanges']) or 'none'} | {other} | {py} |")
        details.append(f"### {name}\n\n- scans: " + "; ".join(f"`{r}`" for r in s["reads"])
                       + ("\n- pushed filters: " + "; ".join(f"`{p}`" for p in s["pushed"]) if s["pushed"] else ""))
    lines += ["", "## Scans", ""] + details
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(out)


if __name__ == "__main__":
    main()
