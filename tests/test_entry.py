import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in q if not n.startswith("op") and n != "pipeline"} <= set(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "name", "friend_id", "friend_name"]
    assert df.count() == 9724


@pytest.mark.parametrize("name", ["top_pages", "unvisited_friends", "latest_access_threshold",
                                  "above_average_degree", "trip_features", "kmeans_converged",
                                  "silhouette_mean", "generate_points"])
def test_against_duckdb_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert got == want
