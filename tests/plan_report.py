"""Write PLANS.md: physical-operator counts of every registered query's initial plan.

    python -m tests.plan_report [sf_dir]
"""

from __future__ import annotations

import collections
import sys

KINDS = ["Exchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate",
         "ObjectHashAggregate", "SortAggregate", "Window", "Sort", "FileScan", "Expand", "Generate"]
SKIP = {"gbt_score", "cv_search", "model_lifecycle", "model_save_load"}


def counts(df):
    from tests.test_queries import _nodes
    c = collections.Counter()
    for n in _nodes(df._jdf.queryExecution().executedPlan()):
        name = n.nodeName()
        if name.startswith("Scan ") or name.startswith("FileScan"):
            name = "FileScan"
        c[name] += 1
    return c


def main(sf_dir: str) -> None:
    sys.path.insert(0, "/root/repo")
    from sparkmart.session import get_session
    import __spark_entry__ as entry

    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, fn in sorted(entry.queries().items()):
        if name in SKIP:
            continue
        c = counts(fn(spark, sf_dir))
        rows.append("| " + " | ".join([name] + [str(c.get(k, 0)) for k in KINDS]) + " |")
    head = ("# Physical plans of the registered queries\n\n"
            f"Operator counts in the initial physical plan (before AQE re-planning) of each registered query's\n"
            f"final DataFrame, built on `{sf_dir}`. Fit passes (vocabularies, means, quantile bounds) and the\n"
            "writes inside composite queries run as separate jobs and are not counted. Broadcast joins appear\n"
            "where the planner proves a side small from file statistics; on large inputs those become\n"
            "sort-merge joins, with AQE splitting skewed partitions. Model queries are omitted.\n\n"
            "| query | " + " | ".join(KINDS) + " |\n| " + " | ".join(["---"] * (len(KINDS) + 1)) + " |\n")
    open("/root/repo/PLANS.md", "w").write(head + "\n".join(rows) + "\n")
    print(len(rows), "queries")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
