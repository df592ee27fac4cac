"""Summarise the final (adaptive) physical plan of each registered query.

    python tools/plan_summary.py [sf_dir] [name ...]

For each query: shuffles, join strategies, aggregates, top-k, scans with
their read schema and pushed filters, and whether any Python evaluation
appears. The query is run (collected) first so the adaptive plan is final.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from egoline.plans.catalog import QUERIES  # noqa: E402
from egoline.session import get_session  # noqa: E402

SKIP = {"land_topics", "follows_pipeline"}


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]  # adaptive plans print the final plan, then the initial one
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                       r"[^\n]*?(Inner|LeftOuter|LeftSemi|LeftAnti|FullOuter|RightOuter)", plan)
    scans = []
    for line in re.findall(r"FileScan [^\n]*", plan):
        fmt = re.match(r"FileScan (\w+)", line).group(1)
        pf = re.search(r"PushedFilters: (\[.*?\]), ReadSchema", line)
        part = re.search(r"PartitionFilters: (\[.*?\]), PushedFilters", line)
        schema = re.search(r"ReadSchema: (struct<.*>)\s*$", line)
        extra = (f" pushed={pf.group(1)}" if pf and pf.group(1) != "[]" else "") + \
                (f" partition={part.group(1)}" if part and part.group(1) != "[]" else "")
        scans.append((fmt, extra, schema.group(1) if schema else "?"))
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange RoundRobinPartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan)),
        "joins": sorted({f"{a}/{b}" for a, b in joins}),
        "partial_aggs": len(re.findall(r"functions=\[partial_", plan)),
        "topk": "TakeOrderedAndProject" in plan,
        "window_group_limit": "WindowGroupLimit" in plan,
        "python": any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")),
        "scans": sorted({f"{fmt} {schema}{extra}" for fmt, extra, schema in scans}),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in QUERIES if n not in SKIP]
    spark = get_session(extra={"spark.ui.showConsoleProgress": "false"})
    for name in names:
        df = QUERIES[name](spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"### {name}")
        print(f"- shuffles: {s['shuffles']}, partial aggregates: {s['partial_aggs']}, joins: {', '.join(s['joins']) or 'none'}"
              f"{', top-k' if s['topk'] else ''}{', window group limit' if s['window_group_limit'] else ''}"
              f"{', PYTHON' if s['python'] else ''}")
        for sc in s["scans"]:
            print(f"- scan {sc}")
    spark.stop()


if __name__ == "__main__":
    main()
