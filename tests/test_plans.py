"""Plan-shape checks: what the scale design relies on."""

import pytest

import __spark_entry__ as E
from tessera.operators import kmeans as K
from tessera.operators import silhouette as SIL
from tessera.sources import standins as S

SF = "/root/testdata/sf0.001"
REPORTS = ["filter_project_nationality", "top_pages", "people_per_nationality", "relationship_degree",
           "access_profile", "unvisited_friends", "friend_page_visits", "latest_access_threshold",
           "latest_access_numeric", "degree_summary", "above_average_degree", "trip_features",
           "mean_card_tip", "generate_points"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_products(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_filters_and_pruning_reach_the_scan(spark):
    p = plan(E.queries()["filter_project_nationality"](spark, SF))
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,NATION_7)" in p
    assert "ReadSchema: struct<c_name:string,c_nationkey:int,c_mktsegment:string>" in p   # no c_acctbal
    q = plan(E.queries()["unvisited_friends"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in q        # rel_id pruned away


def test_unvisited_pairs_need_no_exchange_for_the_anti_join(spark):
    from tessera.operators import graph
    a = S.associates(spark, SF)
    logs = S.logs(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = graph.pair_multiplicity(graph.symmetric_edges(a))
        j = pairs.join(graph.visited_pairs(logs).hint("shuffle_merge"), ["id", "friend_id"], "left_anti")
        p = plan(j)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one exchange per side (the aggregations); the sort-merge anti join reuses them
    assert p.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in p
    # and every exchange ships partial aggregates, never raw edge copies
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1]


def test_latest_access_combines_the_raw_log_without_sorting(spark):
    lines = plan(E.queries()["latest_access_threshold"](spark, SF)).splitlines()
    scan = next(i for i, line in enumerate(lines) if "props" in line and "Scan parquet" in line)
    above = [line for line in lines[:scan] if "Aggregate" in line or "Sort " in line]
    assert "HashAggregate" in above[-1] and "partial_max" in above[-1]


def test_kmeans_input_is_sorted_once_and_rounds_add_no_shuffle(spark):
    """Rounds read the persisted table as it lies; the driver adds up the few
    partial sums, and beyond the bound one shuffle does."""
    w = K.prepare2d(S.points2d(spark, SF))
    try:
        assert w.count() == w.select("x", "y").distinct().count()
        p = plan(w)
        assert "rangepartitioning" in p and "partial_count" in p
        seeds = [(0, 0), (400, 900)]
        direct = K.step_runs(w, {0: seeds}, weight="w", tasks=8)
        assert direct == K.step_runs(w, {0: seeds}, weight="w")
    finally:
        w.unpersist()


def test_silhouette_has_no_cross_product(spark):
    a = spark.createDataFrame([(i, i % 3, i % 17, i % 11) for i in range(200)], "pid long, pos int, x int, y int")
    p = plan(SIL.silhouette_mean(a, block_rows=16))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "FlatMapCoGroupsInPandas" in p
