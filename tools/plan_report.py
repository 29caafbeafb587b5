"""Physical-plan facts of the registered queries on tables -> a markdown table (PLANS.md).

For each query: exchanges (shuffles), join strategies, pushed scan filters,
columns read, and whether any Python runs in the plan. Usage:
    python tools/plan_report.py /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablehaul.registry import QUERIES  # noqa: E402
from tablehaul.session import get_session  # noqa: E402


def facts(plan: str) -> dict:
    scans = re.findall(r"ReadSchema: struct<(.*?)>(?:$|,? ?\w+:|\n)", plan, flags=re.M)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "exchanges": len(re.findall(r"(?<![A-Za-z])Exchange ", plan)),
        "broadcast": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "scans": len(scans),
        "cols_read": "/".join(str(len(s.split(","))) if s else "0" for s in scans),
        "pushed": sum(1 for p in pushed if p.strip()),
        "python": "yes" if re.search(r"(MapInArrow|PythonMapInArrow|ArrowEvalPython|"
                                     r"BatchEvalPython|FlatMapGroupsInPandas)", plan) else "no",
        "topk": "yes" if "TakeOrderedAndProject" in plan else "",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        extra={"spark.sql.maxMetadataStringLength": "100000"})
    rows = []
    for name, fn in sorted(QUERIES.items()):
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, facts(plan)))
    print(f"# Physical plans of the registered queries ({os.path.basename(sf)}, local[8])\n")
    print("Generated by `tools/plan_report.py`. Exchanges = shuffles planned before AQE; "
          "cols read = columns in each scan's ReadSchema; pushed = scans with PushedFilters; "
          "python = any Python operator in the plan.\n")
    print("| query | exchanges | broadcast joins | sort-merge joins | scans | cols read | pushed | "
          "python | top-k |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, f in rows:
        print(f"| {name} | {f['exchanges']} | {f['broadcast']} | {f['smj']} | {f['scans']} | "
              f"{f['cols_read']} | {f['pushed']} | {f['python']} | {f['topk']} |")
    spark.stop()


if __name__ == "__main__":
    main()
