"""Summarise the physical plan of every registered query (markdown table).

    python tools/plan_report.py [sf_dir] > PLANS.md

Per query: shuffles (Exchange nodes), join strategies, window/expand/generate
operators, filters pushed into parquet scans, and any Python evaluation node.
Plans are the initial adaptive plans; AQE may still switch a sort-merge join
to a broadcast join at run time from the measured sizes.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


NOTE = """Generated by `python tools/plan_report.py` for the queries of the core. These are the initial adaptive plans: a
join shown as broadcast was chosen from the size estimate of a small side at this scale; at full scale it becomes a
sort-merge join, and AQE re-plans from the measured sizes. Stream-derived queries read the tables the streaming queries
wrote, so their own plans are scans. `metrics_series*` and `market_trend` write an intermediate table first (the
range-partitioned rows of `ordinal`, after a count; the bucketed lags): the scan, the first shuffle and the sort before
that point run once, in the writing job, and are not part of the plan shown.
"""


def summary(plan: str) -> dict:
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan) if m})
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "joins": ", ".join(sorted(set(joins))) or "-",
        "ops": ", ".join(sorted({o for o in ("Expand", "Window", "Generate", "TakeOrderedAndProject", "ObjectHashAggregate")
                                 if o in plan})) or "-",
        "pushed": " / ".join(p.replace("|", "/") for p in pushed) or "-",
        "python": any(n in plan for n in ("EvalPython", "InPandas", "PythonUDF")),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tickflow.plans import catalog
    from tickflow.session import local_session
    spark = local_session()
    print(f"# Physical plans ({sf_dir})\n")
    print(NOTE)
    print("| query | shuffles | joins | operators | filters pushed to parquet | Python |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        print(f"| {name} | {s['shuffles']} | {s['joins']} | {s['ops']} | {s['pushed']} | {'yes' if s['python'] else 'no'} |")


if __name__ == "__main__":
    main(sys.argv)
