"""Print, per registered query, the physical-plan features that matter at
scale: shuffles, broadcasts, single-partition exchanges, nested-loop or
cartesian joins, sort-based aggregates and Python evaluation.

usage: python scripts/plan_audit.py [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FEATURES = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin",
    "single_partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "sort_aggregate": r"SortAggregate",
    "python": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "staged_reads": r"Scan ExistingRDD|ExistingRDD",
}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from tickflow.plans import QUERIES
    from tickflow.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in a.names or list(QUERIES):
        df = QUERIES[name].fn(spark, a.sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(p, plan)) for k, p in FEATURES.items()}
        scans = re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution()
                           .explainString(spark._jvm.org.apache.spark.sql.execution
                                          .ExplainMode.fromString("formatted")))
        print(f"{name:26s} " + " ".join(f"{k}={v}" for k, v in counts.items() if v),
              "| scan cols:", ";".join(sorted({s[7:-1] for s in scans})))
    spark.stop()


if __name__ == "__main__":
    main()
