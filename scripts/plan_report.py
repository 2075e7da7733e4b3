"""Summarise the final physical plans of the headline queries in "scale mode".

Automatic broadcast is switched off so the plans look as they would when the
users / events tables are far beyond any broadcast threshold; only explicit
broadcasts of bounded tables (calendar, feature catalog) remain. Counts come
from the final adaptive plan of the main query (scalar subqueries are
separate plans and not counted).

    python scripts/plan_report.py [sf_dir] > PLANS.md
"""

import re
import sys

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from bench import HEADLINE  # noqa: E402
from uptake.plans.catalog import REGISTRY  # noqa: E402
from uptake.session import local_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin", "CartesianProduct")


def final_tree(df) -> str:
    ep = df._jdf.queryExecution().executedPlan()
    try:
        return ep.finalPhysicalPlan().treeString()
    except Exception:  # not adaptive
        return ep.treeString()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    print("# Physical plans at scale (auto-broadcast off)\n")
    print("Generated by `scripts/plan_report.py` from the final adaptive plan of each headline query, with "
          "automatic broadcast disabled so data-sized joins plan as they would at 100 TB. *events scans* counts "
          "parquet scans of the event table in the main plan; *reused* counts exchanges Spark executed once and "
          "reused.\n")
    print("| query | events scans | shuffles | reused | joins |")
    print("|---|---:|---:|---:|---|")
    for k in HEADLINE:
        df = REGISTRY[k][0](spark, sf)
        df.collect()
        p = final_tree(df)
        # scans of the event rows (the cached calendar's ts-only scan is printed
        # inside each InMemoryTableScan and is not counted)
        # a subquery prints its initial plan next to its final one: count
        # distinct scan nodes (same text incl. expression ids = same node)
        ev = len(set(re.findall(r"FileScan parquet \[[^\]]*user_id[^\]]*\][^\n]*events\.parquet[^\n]*", p)))
        ex = len(re.findall(r"(?<!Reused)Exchange hashpartitioning", p)) + p.count("Exchange SinglePartition")
        reused = p.count("ReusedExchange")
        joins = [j for j in re.findall("|".join(JOINS), p)]
        jc = ", ".join(f"{j} x{joins.count(j)}" for j in sorted(set(joins)))
        print(f"| {k} | {ev} | {ex} | {reused} | {jc} |")
    spark.stop()


if __name__ == "__main__":
    main()
