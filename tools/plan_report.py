"""Plan audit: shuffles, broadcasts, sorts, window operators and scans of every
registered query, counted over ALL its SQL executions (write, checkpoint and
streaming jobs included) in Spark's event log, written to PLANS.md.

    python tools/plan_report.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = {"shuffles": r"Exchange$|ShuffleExchange", "broadcasts": r"BroadcastExchange", "sorts": r"Sort$",
         "windows": r"Window$", "scans": r"Scan parquet"}


def nodes(plan: dict):
    """Node names of a logged plan; query-stage wrappers of AQE are passed through."""
    yield plan["nodeName"].strip()
    for child in plan["children"]:
        yield from nodes(child)


def counts(log: str) -> dict[str, Counter]:
    """Query name (job description of its executions) -> operator counts and executions."""
    final, names = {}, {}
    for line in open(log):
        e = json.loads(line)
        if "sparkPlanInfo" in e:
            final[e["executionId"]] = e["sparkPlanInfo"]  # the last update is the plan that ran
        if e["Event"].endswith("SparkListenerSQLExecutionStart"):
            names[e["executionId"]] = e.get("description", "")
        if e["Event"] == "SparkListenerJobStart":
            p = e.get("Properties") or {}
            if p.get("spark.sql.execution.id") and p.get("audit.query"):
                names[int(p["spark.sql.execution.id"])] = p["audit.query"]
    out: dict[str, Counter] = {}
    for k, plan in final.items():
        c = out.setdefault(names.get(k, ""), Counter())
        c["executions"] += 1
        for n in nodes(plan):
            for kind, pattern in KINDS.items():
                if re.search(pattern, n) and not (kind == "shuffles" and "Broadcast" in n):
                    c[kind] += 1
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    from tidecast.plans import catalog
    from tidecast.session import get_spark
    folder = tempfile.mkdtemp(prefix="plan-audit-")
    spark = get_spark(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{folder}",
                             "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    done = []
    for name, fn in sorted(catalog.queries().items()):
        if wanted and not any(w in name for w in wanted):
            continue
        spark.sparkContext.setLocalProperty("audit.query", name)
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        done.append(name)
    spark.stop()
    (log,) = [os.path.join(folder, f) for f in os.listdir(folder) if not f.startswith(".")]
    found = counts(log)
    out = ["# Physical plan audit", "",
           "Generated by `tools/plan_report.py`: every registered query of the panel part is run once and its operators are "
           "counted over all its SQL executions (write, checkpoint and streaming jobs included) in Spark's event log. "
           "Plans are the final adaptive ones.", "",
           "| query | executions | shuffles | broadcasts | sorts | window ops | parquet scans |", "| --- | --- | --- | --- | --- | --- | --- |"]
    for name in done:
        c = found.get(name, Counter())
        out.append(f"| `{name}` | {c['executions']} | {c['shuffles']} | {c['broadcasts']} | {c['sorts']} | {c['windows']} | {c['scans']} |")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    if not wanted:
        open(path, "w").write("\n".join(out) + "\n")
    print("\n".join(out[-len(done):]))


if __name__ == "__main__":
    main()
