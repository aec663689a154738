"""Summarise the physical plan of every registered job into PLANS.md.

Usage: python tests/plan_report.py [sf_dir] [out.md]
Counts shuffles, broadcasts, joins, aggregations, Python stages and scans
(with pushed filters and read columns) from the formatted plan, and flags
nested-loop or cartesian joins.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (.+?)\s*$", plan, re.M)
    count = lambda pat: sum(1 for n in nodes if re.match(pat, n))
    scans = re.findall(r"\(\d+\) Scan parquet.*?\nOutput \[\d+\]: \[(.*?)\].*?(?:PushedFilters: \[(.*?)\])?"
                       r".*?ReadSchema: (struct<.*?>)\n", plan, re.S)
    return {
        "shuffles": count(r"Exchange$"),
        "broadcasts": count(r"BroadcastExchange"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "aggs": count(r"(Hash|ObjectHash)Aggregate"),
        "sort_aggs": count(r"SortAggregate"),
        "python": count(r"(MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)"),
        "bad_joins": count(r"(BroadcastNestedLoopJoin|CartesianProduct)"),
        "scans": [(s[2], s[1]) for s in scans],
    }


def main() -> None:
    from blogweave.session import build_session
    from blogweave.plans.jobs import JOBS
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(ROOT, "PLANS.md")
    spark = build_session("local[4]", shuffle_partitions=8)
    lines = ["# Physical plans", "",
             f"Generated by `tests/plan_report.py` on `{sf}` (initial adaptive plans, before AQE re-planning).",
             "Shuffles = `Exchange` nodes; broadcasts come from the planner's size check only.  `jobs run first`:",
             "Spark jobs that ran while the plan was built (tables written to the scratch folder, bounds).", "",
             "| Job | shuffles | broadcasts | SMJ | BHJ | hash aggregates | sort aggregates | Python stages | nested-loop/cartesian | jobs run first |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    details = []
    for name, fn in sorted(JOBS.items()):
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, sf)
        eager = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summarise(plan)
        lines.append(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['aggs']} | {s['sort_aggs']} "
                     f"| {s['python']} | {s['bad_joins']} | {eager} |")
        details.append(f"### {name}\n")
        for schema, pushed in s["scans"]:
            details.append(f"- scan `{schema}`" + (f", pushed `{pushed}`" if pushed else ""))
        details.append("")
    with open(out, "w") as f:
        f.write("\n".join(lines + ["", "## Scans (read columns, pushed filters)", ""] + details))
    print(out)


if __name__ == "__main__":
    main()
