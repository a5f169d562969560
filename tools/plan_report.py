"""Summarise the physical plan of every registered query into PLANS.md.

    python tools/plan_report.py [sf_dir] > PLANS.md

Counts operators in the executed (adaptive, final) plan after running the
query once: exchanges (shuffles), sorts, window nodes, joins (and which
kind), broadcast exchanges, scans and their pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    count = lambda pat: sum(1 for ln in lines if re.search(pat, ln))
    joins = sorted({m.group(0) for ln in lines for m in [re.search(r"\b\w+Join\b", ln)] if m})
    pushed = sorted({m.group(1)[:70] for ln in lines for m in [re.search(r"PushedFilters: \[([^\]]*)", ln)]
                     if m and m.group(1)})
    return {
        "shuffles": count(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
        "sorts": count(r"\+- Sort \[|^Sort \["),
        "windows": count(r"\+- Window \[|^Window \["),
        "joins": ", ".join(joins) or "-",
        "broadcasts": count(r"BroadcastExchange"),
        "scans": count(r"Scan parquet|FileScan parquet|Scan ExistingRDD"),
        "pushed": "; ".join(pushed) or "-",
    }


def main():
    from setbook.plans import catalog
    from setbook.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=16, conf={"spark.driver.memory": "8g"})
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` from the final adaptive plans "
          "(after one run). Shuffles count hash/range/single-partition exchanges, including those "
          "inside scalar subqueries.\n")
    print("| query | shuffles | sorts | windows | joins | broadcasts | scans | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.queries().items():
        df = fn(spark, sf_dir)
        df.collect()          # runs this very execution, so its adaptive plan is the final one
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.startswith("AdaptiveSparkPlan isFinalPlan=true") or "Adaptive" not in plan, name
        plan = plan.split("+- == Initial Plan ==")[0]
        s = summarise(plan)
        print(f"| {name} | {s['shuffles']} | {s['sorts']} | {s['windows']} | {s['joins']} | "
              f"{s['broadcasts']} | {s['scans']} | {s['pushed']} |")
    spark.stop()


if __name__ == "__main__":
    main()
