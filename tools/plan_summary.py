"""Summarise the physical plans of registered queries (for PLANS.md).

Usage: python tools/plan_summary.py [sf_dir] [name ...]
Counts scans, shuffles, broadcasts, join strategies and windows in the plan
Spark picks (before adaptive re-planning), and lists the filters pushed into
each scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.catalog.spark_queries import QUERIES  # noqa: E402
from starmart.session import local_session  # noqa: E402

NODES = ["FileScan", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "Window", "HashAggregate",
         "Subquery"]


def summary(plan: str) -> dict[str, int]:
    return {n: plan.count(n) for n in NODES if plan.count(n)}


def pushed(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line or "PushedFilters: [" not in line:
            continue
        loc = re.search(r"InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", line)
        table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
        filters = line.split("PushedFilters: [", 1)[1].split(", ReadSchema", 1)[0].rstrip("]")
        if filters:
            out.append(f"{table}: {filters}")
    return out


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    names = argv[1:] or sorted(QUERIES)
    spark = local_session()
    for name in names:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(f"| `{name}` | {', '.join(f'{k} {v}' for k, v in summary(plan).items())} | "
              f"{'; '.join(pushed(plan)) or '-'} |")


if __name__ == "__main__":
    main(sys.argv[1:])
