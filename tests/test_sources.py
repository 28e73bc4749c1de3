import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators.joins import checked_broadcast, measured_size
from tessera.sources import delimited as D
from tessera.sources import generate as G


def scratch():
    return tempfile.mkdtemp(prefix="tessera-test-")


def write_text(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_malformed_people_rows(spark):
    d = scratch()
    p = write_text(os.path.join(d, "people.csv"), 'bad,Joe,US,1,z\n2,Ann,US\n3,"Q,x",FR,4,h\n')
    rows = [tuple(r) for r in D.read_people(spark, p).collect()]
    assert rows[0] == (None, "Joe", "US", 1, "z")
    assert rows[1] == (2, "Ann", "US", None, None)
    # no quote handling: the quote is data and the comma splits
    assert rows[2][:3] == (3, '"Q', 'x"')


def test_logs_and_associates(spark):
    d = scratch()
    lp = write_text(os.path.join(d, "logs.csv"), "1,2,3,view,00017\n")
    ap = write_text(os.path.join(d, "assoc.csv"), "9,1,2,2020-01-01,college\n")
    assert tuple(D.read_logs(spark, lp).first()) == (1, 2, 3, "view", "00017")
    assert tuple(D.read_associates(spark, ap).first()) == (9, 1, 2, "2020-01-01", "college")


def test_delimited_round_trip_and_modes(spark):
    d = scratch()
    out = os.path.join(d, "report")
    df = spark.createDataFrame([("a", 1), (None, 2)], "name string, n int")
    D.write_delimited(df, out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == [",2", "a,1"]
    D.write_delimited(df.limit(1).where(F.col("n") == 1), out)            # overwrite
    assert [r.value for r in spark.read.text(out).collect()] == ["a,1"]
    D.write_delimited(df, out, mode="ignore")                              # kept
    assert [r.value for r in spark.read.text(out).collect()] == ["a,1"]


def test_points_seeds_and_assignments(spark):
    d = scratch()
    pp = write_text(os.path.join(d, "points.csv"), "1,2\n3,4\nx,5\n")
    sp = write_text(os.path.join(d, "seeds.csv"), "30,40\n10,20\n")
    pts = D.read_points2d(spark, pp)
    # a malformed line is a row with a null: the jobs skip and count it
    assert [(r.x, r.y) for r in pts.collect()] == [(1, 2), (3, 4), (None, 5)]
    assert D.read_seeds2d(spark, sp) == [(30, 40), (10, 20)]
    a = spark.createDataFrame([(10, 20, 1, 2)], "cx int, cy int, x int, y int")
    ap = os.path.join(d, "final")
    D.write_assignments2d(a, ap)
    assert spark.read.text(ap).first().value == "10,20\t1,2"
    D.write_assignments2d(a, ap, grouped=True)
    assert spark.read.text(ap).first().value == "10,20\t1,2"
    assert tuple(D.read_assignments2d(spark, ap).first()) == (10, 20, 1, 2)


def test_nd_readers(spark):
    d = scratch()
    pp = write_text(os.path.join(d, "nd.csv"), "1.5,2,3\n4,5,6\n")
    sp = write_text(os.path.join(d, "ndseeds.csv"), "10,1,2,3\n2,4,5,6\n")
    rows = sorted(r.coords for r in D.read_points_nd(spark, pp).collect())
    assert rows == [[1.5, 2.0, 3.0], [4.0, 5.0, 6.0]]
    assert D.read_seeds_nd(spark, sp) == [(10, [1.0, 2.0, 3.0]), (2, [4.0, 5.0, 6.0])]


def test_history_partitioned_by_iteration(spark):
    d = scratch()
    h = spark.createDataFrame([(1, 0, 5, 6), (2, 0, 7, 8)], "iteration int, pos int, x int, y int")
    D.write_history(h, os.path.join(d, "hist"))
    parts = sorted(n for n in os.listdir(os.path.join(d, "hist")) if n.startswith("iteration="))
    assert parts == ["iteration=1", "iteration=2"]
    back = spark.read.text(os.path.join(d, "hist", "iteration=2")).first().value
    assert back == "0,7,8"


def test_trips_csv_reader(spark):
    d = scratch()
    hdr = ",".join(f.name for f in D.TRIPS.fields)
    line = "2,2016-03-01 00:00:00,2016-03-01 00:07:55,1,2.5,-73.9,40.7,1,N,-73.9,40.7,1,9.0,0.5,0.5,2.05,0,0.3,12.35"
    p = write_text(os.path.join(d, "trips.csv"), hdr + "\n" + line + "\n")
    r = D.read_trips(spark, p).first()
    assert r["passenger_count"] == 1 and r["tpep_dropoff_datetime"].minute == 7


def test_generator_is_deterministic_and_bounded(spark):
    a = G.points_range(spark, 2000, seed=3)
    b = G.points_range(spark, 2000, seed=3).repartition(7)
    ra = sorted(map(tuple, a.collect()))
    assert ra == sorted(map(tuple, b.collect()))
    assert all(0 <= x <= 10000 and 0 <= y <= 10000 for _, x, y in ra)
    assert len({(x, y) for _, x, y in ra}) > 1990
    d = scratch()
    G.write_points(a, os.path.join(d, "pts"))
    G.write_points(G.points_range(spark, 5, seed=4), os.path.join(d, "pts"))   # kept
    assert spark.read.text(os.path.join(d, "pts")).count() == 2000
    G.write_seeds(G.points_range(spark, 5, seed=4), os.path.join(d, "seeds"))
    G.write_seeds(G.points_range(spark, 3, seed=4), os.path.join(d, "seeds"))  # replaced
    assert spark.read.text(os.path.join(d, "seeds")).count() == 3


def test_checked_broadcast(spark):
    small = spark.range(10).withColumn("s", F.lit("abc"))
    rows, size = measured_size(small)
    assert rows == 10 and size > 10 * 16
    big = spark.range(100).withColumnRenamed("id", "k")
    plan = big.join(checked_broadcast(small.withColumnRenamed("id", "k")), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    plan2 = big.join(checked_broadcast(small.withColumnRenamed("id", "k"), max_rows=5), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan2


def test_checked_broadcast_skips_large_inputs_without_measuring(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    big = spark.range(100).withColumnRenamed("id", "k")
    hinted = checked_broadcast(small, max_input_bytes=1)
    plan = big.join(hinted, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_trips_reader_matches_columns_by_name(spark):
    d = scratch()
    p = write_text(os.path.join(d, "trips2.csv"),
                   "total_amount,passenger_count,tpep_pickup_datetime,extra_col\n"
                   "12.5,2,2016-03-01 08:09:10,zz\nbad,3,2016-03-01 08:09:11,yy\n")
    rows = D.read_trips(spark, p).collect()
    assert rows[0]["total_amount"] == 12.5 and rows[0]["passenger_count"] == 2
    assert rows[0]["tpep_pickup_datetime"].hour == 8 and rows[0]["extra_col"] == "zz"
    assert rows[1]["total_amount"] is None


def test_oversized_seed_file_is_refused(spark, monkeypatch):
    import pytest
    d = scratch()
    p = write_text(os.path.join(d, "many.csv"), "".join(f"{i},{i}\n" for i in range(5)))
    monkeypatch.setattr(D, "MAX_SEEDS", 3)
    with pytest.raises(ValueError):
        D.read_seeds2d(spark, p)


def test_generated_points_are_no_lattice(spark):
    rows = G.points_range(spark, 5000).orderBy("pid").collect()
    other = G.points_range(spark, 5000, seed=8).orderBy("pid").collect()
    steps = {((b.x - a.x) % 10001, (b.y - a.y) % 10001) for a, b in zip(rows, rows[1:])}
    assert len(steps) > 4900 and len({(b.x - a.x) % 10001 for a, b in zip(rows, rows[1:])}) > 3500
    assert len({(b.x - a.x, b.y - a.y) for a, b in zip(rows, other)}) > 4900
    for axis in ("x", "y"):
        bins = [0] * 50
        for r in rows:
            bins[r[axis] * 50 // 10001] += 1
        assert sum((n - 100) ** 2 / 100 for n in bins) < 95      # chi-square, 49 degrees, p about 0.0001


def test_malformed_assignments_are_null(spark):
    lines = spark.createDataFrame([("1,2\t3,4",), ("1,2\tx,4",), ("1,2",), ("1\t3",), ("a\tb\tc",), ("",)], "value string")
    got = [tuple(r) for r in D.parse_assignments2d(lines).collect()]
    assert got == [(1, 2, 3, 4), (1, 2, None, 4), (None,) * 4, (1, None, 3, None), (None,) * 4, (None,) * 4]


def test_one_typing_rule(spark):
    """Blanks around a field do not count, whatever its type; empty is null."""
    p = write_text(os.path.join(scratch(), "p.csv"), " 12,ann,US,1,z\n12 , bob ,US, 2 ,z\n5,,,,\n\n")
    assert [tuple(r) for r in D.read_people(spark, p).collect()] == [
        (12, "ann", "US", 1, "z"), (12, "bob", "US", 2, "z"), (5, None, None, None, None)]


def test_bad_lines_are_counted_by_reason_and_kept(spark):
    text = "1,ann,US,1,z\nbad,Joe,US,1,z\n2,Ann,US\n3,a,b,4,h,more\n4,Bo,FR,4.5,h\n5,,,,\n"
    p = write_text(os.path.join(scratch(), "people.csv"), text)
    f = D.checked(spark, p, D.PEOPLE)
    told = {"rows": 6, "missing field": 1, "extra field": 1, "bad value": 2}
    kept = os.path.join(scratch(), "bad")
    assert f.check() == told and f.check(kept) == told
    assert sorted(r.value for r in spark.read.text(kept).collect())[0] == "bad value\tcountry_code\t4,Bo,FR,4.5,h"
    assert [r[0] for r in f.rows.select("id").collect()] == [1, None, 2, 3, 4, 5]
    assert sorted((r["line"], r["reason"], tuple(r["nulls"])) for r in f.bad.collect()) == [
        ("2,Ann,US", "missing field", ("country_code", "hobby")), ("3,a,b,4,h,more", "extra field", ()),
        ("4,Bo,FR,4.5,h", "bad value", ("country_code",)), ("bad,Joe,US,1,z", "bad value", ("id",))]
    whole = [tuple(r) for r in D.read_people(spark, p).collect()]
    assert [tuple(r) for r in D.checked(spark, p, D.PEOPLE).rows.collect()] == whole


def test_seed_lines_that_are_none_are_skipped_and_counted(spark):
    d = scratch()
    two = D.read_seeds2d(spark, write_text(os.path.join(d, "s.csv"), "1, 2\nx,3\n4\n5,6,7\n\n"))
    assert two == [(1, 2), (5, 6)] and two.skipped == 3
    nd = D.read_seeds_nd(spark, write_text(os.path.join(d, "n.csv"), "7, 1.5 ,2\nx,1,2\n8,1,none\n9\n"))
    assert nd == [(7, [1.5, 2.0])] and nd.skipped == 3


def test_history_is_read_back_by_partition(spark):
    d = os.path.join(scratch(), "hist")
    h = spark.createDataFrame([(1, 0, 5, 6), (2, 0, 7, 8), (2, 1, None, 9)], "iteration int, pos int, x int, y int")
    D.write_history(h, d)
    back = D.read_history(spark, d, "pos int, x int, y int")
    assert back.dtypes == h.dtypes and sorted(map(str, back.collect())) == sorted(map(str, h.collect()))
    assert "PartitionFilters: [isnotnull(iteration" in back.where("iteration = 2")._jdf.queryExecution().executedPlan().toString()
