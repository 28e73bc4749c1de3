"""Summarise the physical plan of every single-plan query (markdown table).

Usage: python tests/plan_summary.py [sf_dir]
The k-means jobs are driver loops; their per-round plan is summarised once.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tessera.operators import kmeans as K  # noqa: E402
from tessera.operators import silhouette as SIL  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources import standins as S  # noqa: E402

SINGLE = ["filter_project_nationality", "top_pages", "people_per_nationality", "relationship_degree",
          "access_profile", "unvisited_friends", "friend_page_visits", "latest_access_threshold",
          "latest_access_numeric", "degree_summary", "above_average_degree", "trip_features",
          "mean_card_tip", "generate_points"]


def summarise(name, df):
    p = df._jdf.queryExecution().executedPlan().toString()
    p = p.split("InMemoryTableScan")[0] if "InMemoryTableScan" in p else p
    ex = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobin|rangepartitioning)", p))
    bex = p.count("BroadcastExchange")
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                  r"CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi)", p)))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", p))
    cols = "; ".join(s.replace(":bigint", "").replace(":string", "").replace(":int", "")
                     .replace(":double", "").replace(":timestamp_ntz", "") for s in scans)
    j = ", ".join(f"{a} {b}" for a, b in joins) or "-"
    print(f"| {name} | {ex} | {bex} | {j} | {pushed} | {cols} |")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 8)
    print("| query | shuffle exchanges | broadcast exchanges | joins | scans with pushed filters | columns read |")
    print("|---|---|---|---|---|---|")
    for name in SINGLE:
        summarise(name, E.queries()[name](spark, sf_dir))
    pts = S.points2d(spark, sf_dir)
    w = K.prepare2d(pts)
    summarise("(k-means input, 2-D: persisted once)", w)
    w.unpersist()
    a = K.assign2d(pts, S.seeds2d(pts, 10))
    summarise("(silhouette mean, after k-means)", SIL.silhouette_mean(a))
    spark.stop()


if __name__ == "__main__":
    main()
