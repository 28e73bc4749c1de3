from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.plans import reports as R

PEOPLE = "id int, name string, nationality string, country_code int, hobby string"
LOGS = "acc_id int, by_who int, what_page int, type_of_access string, access_time string"
ASSOC = "rel_id int, person_a int, person_b int"


def people(spark, n=4, nat=None):
    return spark.createDataFrame(
        [(i, f"P{i}", (nat or {}).get(i, "US"), 1, "h") for i in range(1, n + 1)], PEOPLE)


def test_filter_project(spark):
    p = people(spark, 3, {2: "FR"})
    rows = R.nationality_people(p, "FR").collect()
    assert [tuple(r) for r in rows] == [("P2", "h")]


def test_degree_counts_repeats_and_self_edges(spark):
    assoc = spark.createDataFrame([(1, 1, 2), (2, 1, 2), (3, 3, 3)], ASSOC)
    out = dict((r["owner_name"], r["happiness_factor"])
               for r in R.relationship_degree(people(spark), assoc).collect())
    assert out == {"P1": 2, "P2": 2, "P3": 2, "P4": 0}


def test_unvisited_single_log(spark):
    assoc = spark.createDataFrame([(1, 1, 2)], ASSOC)
    logs = spark.createDataFrame([(1, 1, 2, "v", "5")], LOGS)
    rows = sorted(tuple(r) for r in R.unvisited_friends(people(spark), assoc, logs).collect())
    assert rows == [(2, "P2", 1, "P1")]


def test_unvisited_repeated_edge_keeps_copies(spark):
    assoc = spark.createDataFrame([(1, 1, 2), (2, 1, 2)], ASSOC)
    logs = spark.createDataFrame([], LOGS)
    rows = sorted(tuple(r) for r in R.unvisited_friends(people(spark), assoc, logs).collect())
    assert rows == [(1, "P1", 2, "P2")] * 2 + [(2, "P2", 1, "P1")] * 2


def test_unvisited_hot_pair_split_in_pieces(spark):
    # 7 copies of one pair, pieces of 3 rows: 3 + 3 + 1 per direction
    assoc = spark.createDataFrame([(i, 1, 2) for i in range(7)], ASSOC)
    logs = spark.createDataFrame([(1, 2, 1, "v", "5")], LOGS)   # 2 opened 1's page
    rows = sorted(tuple(r) for r in R.unvisited_friends(people(spark), assoc, logs, piece_rows=3).collect())
    assert rows == [(1, "P1", 2, "P2")] * 7


def test_anti_join_equals_outer_join_is_null(spark):
    assoc = spark.createDataFrame([(i, i % 5, (i * 3) % 7) for i in range(40)], ASSOC)
    logs = spark.createDataFrame([(i, i % 5, (i * 2) % 7, "v", "1") for i in range(30)], LOGS)
    edges = graph.symmetric_edges(assoc)
    visited = graph.visited_pairs(logs)
    anti = edges.join(visited, ["id", "friend_id"], "left_anti")
    v2 = visited.select(F.col("id").alias("vid"), F.col("friend_id").alias("vf"))
    outer = (edges.join(v2, (edges.id == v2.vid) & (edges.friend_id == v2.vf), "left")
             .where(F.col("vid").isNull()).select("id", "friend_id"))
    assert sorted(map(tuple, anti.collect())) == sorted(map(tuple, outer.collect()))


def test_text_maximum_vs_numeric(spark):
    p = people(spark, 2)
    logs = spark.createDataFrame([(1, 1, 1, "v", "99999"), (2, 1, 1, "v", "1000000")], LOGS)
    assert R.latest_access(p, logs, 870400, "text").collect() == []
    assert [tuple(r) for r in R.latest_access(p, logs, 870400, "numeric").collect()] == [(1, "P1")]
    assert [tuple(r) for r in R.latest_access(p, logs, 870400, "text", keep="lt").collect()] == [(1, "P1")]


def test_latest_text_is_the_text_maximum(spark):
    texts = ["1", "10", "100", "09", "9", "0", "9" * 16, "9" * 17, "1" * 40, "", " 12", "12 ", "12\n", "-3", "ab", "é", "٣", None]
    pages = [texts[i:i + n] for n in (1, 2, 3, 5, 18) for i in range(len(texts))] + [[None, None]]
    logs = spark.createDataFrame([(1, 1, p, "v", t) for p, ts in enumerate(pages) for t in ts], LOGS)
    got = {r["id"]: r["latest"] for r in R._latest_text(logs).collect()}
    assert got == {p: max((t for t in ts if t is not None), key=str.encode, default=None) for p, ts in enumerate(pages)}


def test_above_average(spark):
    # degrees 1, 2, 2, 5 -> mean 2.5 -> only the 5
    rows = [(1, 1, 9)] + [(2, 2, 10), (3, 2, 10)] + [(4, 3, 11), (5, 3, 11)] + [(6 + i, 4, 12) for i in range(5)]
    assoc = spark.createDataFrame(rows, ASSOC)
    p = people(spark, 4)
    s = R.degree_summary(assoc).first()
    # ends: 1,2,2,3,3,4x5 plus partners 9,10,10,11,11,12x5
    assert s["num_owners"] == 8 and s["total_relationships"] == 20
    out = [tuple(r) for r in R.above_average_degree(p, assoc).collect()]
    assert out == [(4, "P4", 5)]


def test_top_pages_ties_by_id(spark):
    p = people(spark, 4)
    logs = spark.createDataFrame(
        [(i, 1, pg, "v", "1") for i, pg in enumerate([3, 3, 2, 2, 1, 4, 4, 4])], LOGS)
    rows = [r["id"] for r in R.top_pages(p, logs, 3).collect()]
    assert rows == [4, 2, 3]


def test_access_profile_counts_and_nulls(spark):
    p = people(spark, 3)
    logs = spark.createDataFrame(
        [(1, 1, 5, "v", "1"), (2, 1, 5, "v", "1"), (3, 1, 6, "v", "1"), (None, 1, 7, "v", "1"),
         (4, 2, None, "v", "1")], LOGS)
    out = {r["owner_name"]: (r["total_accesses"], r["distinct_pages_accessed"])
           for r in R.access_profile(p, logs).collect()}
    # the row with a null acc_id is not counted; its page still is distinct
    assert out == {"P1": (3, 3), "P2": (1, 0), "P3": (0, 0)}


def test_people_per_nationality(spark):
    p = people(spark, 4, {1: "FR", 2: "FR"})
    out = {r["nationality"]: r["citizen_count"] for r in R.people_per_nationality(p).collect()}
    assert out == {"FR": 2, "US": 2}


def test_hot_pair_and_hot_person_at_moderate_size(spark):
    # one relation copied 300,000 times (several pieces), plus a person related to 5,000 others
    hot = spark.range(300_000).select(F.col("id").cast("int").alias("rel_id"), F.lit(1).alias("person_a"),
                                      F.lit(2).alias("person_b"))
    fan = spark.range(5_000).select((F.col("id") + 1_000_000).cast("int").alias("rel_id"), F.lit(3).alias("person_a"),
                                    (F.col("id") + 10).cast("int").alias("person_b"))
    assoc = hot.unionByName(fan)
    people = spark.range(1, 6_000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("P"), F.col("id")).alias("name"),
                                         F.lit("US").alias("nationality"), F.lit(1).alias("country_code"),
                                         F.lit("h").alias("hobby"))
    logs = spark.createDataFrame([(1, 2, 1, "v", "5")], LOGS)          # 2 opened 1's page
    out = R.unvisited_friends(people, assoc, logs)
    counts = {tuple(r[:2]): r[2] for r in out.groupBy("id", "friend_id").count().collect()}
    assert counts[(1, 2)] == 300_000 and (2, 1) not in counts
    assert counts[(3, 10)] == 1 and counts[(10, 3)] == 1
    assert out.count() == 300_000 + 2 * 5_000
    deg = {r["owner_name"]: r["happiness_factor"] for r in R.relationship_degree(people, assoc).collect()}
    assert deg["P1"] == 300_000 and deg["P2"] == 300_000 and deg["P3"] == 5_000


def test_split_multiplicity_is_exact_for_huge_counts(spark):
    big = (1 << 62) + 12345
    df = spark.createDataFrame([(1, 2, big), (3, 4, 65536), (5, 6, 65537)], "id long, friend_id long, mult long")
    piece_rows = 1 << 40
    out = graph.split_multiplicity(df, "mult", piece_rows).groupBy("id").agg(
        F.sum("n").cast("decimal(38,0)").alias("total"), F.min("n").alias("smallest"), F.count("*").alias("pieces"))
    got = {r["id"]: (int(r["total"]), r["smallest"], r["pieces"]) for r in out.collect()}
    assert got[1][0] == big and got[1][1] > 0 and got[1][2] == (big - 1) // piece_rows + 1
    assert got[3] == (65536, 65536, 1) and got[5] == (65537, 65537, 1)


def test_pairs_of_large_tables_are_dealt_by_input_size(spark, tmp_path, monkeypatch):
    from tessera.operators import graph

    rows = [(1, 2)] * 500 + [(i % 40, i % 17) for i in range(2000)] + [(None, 3), (3, None), (None, None), (None, None)]
    spark.createDataFrame(rows, "person_a long, person_b long").write.parquet(str(tmp_path / "a"))
    edges = graph.symmetric_edges(spark.read.parquet(str(tmp_path / "a")))
    plain = graph.pair_multiplicity(edges)
    size = graph.input_bytes(edges)
    found = []
    for share in (20, 60):                      # three times as many partitions where the input is three times a share
        monkeypatch.setattr(graph, "PAIR_INPUT_BYTES", size // share)
        dealt = graph.pair_multiplicity(edges)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        found.append(dealt.rdd.getNumPartitions())
    assert found[0] >= 20 and found[1] >= 60
    assert {r["mult"] for r in dealt.where("id = 2 AND friend_id = 1").collect()} == {
        rows.count((1, 2)) + rows.count((2, 1))}
