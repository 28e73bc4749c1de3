"""The registered queries on the small test tables, and the pipeline."""

import random

import brute
import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tessera.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_registered():
    q = E.queries()
    assert set(Q.queries()) <= set(q) and q["pipeline"] is P.run
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "mixing"]
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_duckdb(spark, duck, name):
    df, rel = Q.queries()[name](spark, SF), duck.sql(Q.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    order = lambda rows: sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
    got = order([tuple(r[c] for c in cols) for r in df.collect()])
    assert got == order([tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()])


@pytest.mark.parametrize("name", ["op4_quality", "op5_toxicity", "op7_language_id"])
def test_one_row_per_document(spark, name):
    rows = Q.queries()[name](spark, SF).collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids) and all(0 <= r["score"] <= 1 for r in rows)


def test_stages_one_by_one(spark, table, labels, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    item, base = text(30), text(80)
    rows = [(i, text(40), "en", rng.choice("abc")) for i in range(60)]
    rows += [(60 + i, base + f" end{i}", "en", "a") for i in range(5)]
    rows += [(70, text(50) + " " + item + " " + text(9), "en", "b"), (71, "you stupid worthless moron " + text(20), "en", "b"),
             (72, None, "en", None), (73, "", "en", "c"), (74, "", "en", "c"), (None, text(20), "en", "a"),
             (77, base + " a row that repeats", "en", "a"), (78, "row twice " + base[:99], "en", "a"), (78, "row twice " + base[:99], "en", "a"),
             (75, "line that is shared\n" + text(20), "en", "a"), (76, "line that is shared\n" + text(20), "en", "a")]
    docs = table(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels([]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    order = lambda rows: sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
    state, kept = rows, docs
    for name, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        if name == "toxicity":
            state = [r for r in state if r[0] != 71]
        elif name == "line_dedup":
            state = [(i, t if i != 76 else t.split("\n")[1], la, s) for i, t, la, s in state]
        elif name == "ngram_jaccard":
            comp = {d: c for d, _, c in brute.jaccard([r[:2] for r in state])}
            state = [r for r in dict.fromkeys(state) if r[0] is None or comp[r[0]] == r[0]]
        else:
            bad = {d for d, *_ in brute.leaks([r[:2] for r in state], [(1, item)])}
            state = [r for r in state if r[0] not in bad]
        got = [tuple(r) for r in kept.select("doc_id", "text", "lang", "source").collect()]
        assert order(got) == order(state), name
        assert all(r["score"] == -1.0 and r["row"] == "x" for r in kept.collect())
    # rows without an id, or sharing one, are judged one by one
    leak = text(9) + " " + item
    few = table([(None, leak, "en", "a"), (None, "clean " + base, "en", "a"), (5, leak, "en", "a"), (5, base, "en", "b"),
                 (6, None, "en", "a"), (6, "", "en", "a")])
    assert order([tuple(r) for r in P.decontamination(spark, few, str(tmp_path)).select("doc_id", "text").collect()]) == order(
        [(None, "clean " + base), (5, base), (6, None), (6, "")])
    out = P.run(spark, str(tmp_path))
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r[0]) for r in state)
    # the last stage is the mix of what is left, as SQL has it
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in state])
    rel = con.sql(Q.mix_sql())
    cols = sorted(out.columns)
    assert order([tuple(r[c] for c in cols) for r in out.collect()]) == order(
        [tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()])


def test_near_duplicates_by_row(spark, table):
    """Rows without an id, or sharing one, are linked and dropped one by one."""
    rng = random.Random(12)
    a, b, c, d, x = (" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(5))
    rows = [(None, a + " one"), (None, a + " two"), (None, a), (None, a), (3, x), (5, b), (5, x + " near"),
            (8, c), (8, c + " near"), (9, d + " near"), (None, d), (None, d), (None, ""), (None, ""), (None, None),
            (11, None), (11, ""), (12, "")]
    for part in (rows, rows[::-1]):
        kept = [tuple(r) for r in P.near_duplicates(spark, table(part), "").select("doc_id", "text").collect()]
        of = lambda t: [r for r in kept if r[1] and r[1].startswith(t)]
        assert len(of(a)) == len(of(c)) == 1 and of(a)[0][0] is None and of(c)[0][0] == 8
        assert of(x) == [(3, x)] and of(b) == [(5, b)] and of(d) == [(9, d + " near")]
        assert sorted(str(r) for r in kept if not r[1]) == sorted(str(r) for r in rows if not r[1])
        assert len(kept) == 5 + 6


def test_decontamination_by_item(spark, table, tmp_path):
    """Items that share an id, or have none, are searched one by one."""
    rng = random.Random(13)
    a, b, c, d = (" ".join(f"w{rng.randrange(5000)}" for _ in range(30)) for _ in range(4))
    spark.createDataFrame([(1, a), (1, b), (None, c), (None, None), (2, "too short")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs = table([(1, "before " + a), (2, b + " after"), (3, c), (4, d), (5, "too short"), (6, None)])
    kept = P.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in kept) == [4, 5, 6]


def test_empty_tables_and_very_long_texts(spark, tmp_path):
    """Each stage and the whole run over empty tables, and over texts of a
    hundred thousand words; only the last stage's input is kept."""
    import glob

    from tessera.llm.common import shared_dir

    docs = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(100_000))
    for name, rows in (("none", []), ("long", [(1, long, "en", "a", 1), (2, long + " more", "en", "b", 1), (3, "short", None, None, None)])):
        d = tmp_path / name
        spark.createDataFrame(rows, docs).write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        before = set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/tessera-pipeline-*"))
        got = P.run(spark, str(d)).collect()
        assert sorted(r["doc_id"] for r in got) == ([1, 3] if rows else [])
        assert len(set(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/tessera-pipeline-*")) - before) == 1
