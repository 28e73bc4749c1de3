import os
import tempfile

import pytest

from tessera import cli


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="tessera-cli-")
    return {
        "dir": d,
        "people": write(os.path.join(d, "people.csv"), "1,Ann,US,1,chess\n2,Bob,FR,2,golf\n3,Cy,US,1,go\n"),
        "logs": write(os.path.join(d, "logs.csv"), "1,1,2,view,99999\n2,2,1,view,10\n3,3,2,view,1000000\n"),
        "assoc": write(os.path.join(d, "assoc.csv"), "1,1,2,2020,x\n2,2,3,2020,y\n"),
        "points": write(os.path.join(d, "points.csv"), "0,0\n1,0\n10,10\n11,10\n"),
        "seeds": write(os.path.join(d, "seeds.csv"), "0,0\n10,10\n"),
        "ndpoints": write(os.path.join(d, "nd.csv"), "0,0,0\n1,0,0\n10,10,10\n11,10,10\n"),
        "ndseeds": write(os.path.join(d, "ndseeds.csv"), "1,0,0,0\n2,10,10,10\n"),
    }


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_report_f(spark, files):
    out = os.path.join(files["dir"], "F")
    cli.main(["report", "F", "--people", files["people"], "--logs", files["logs"],
              "--associates", files["assoc"], "--out", out])
    assert lines(spark, out) == ["2,Bob,3,Cy"]          # 1->2, 2->1 and 3->2 were opened


def test_report_g_text_order(spark, files):
    out = os.path.join(files["dir"], "G")
    cli.main(["report", "G", "--people", files["people"], "--logs", files["logs"], "--out", out])
    assert lines(spark, out) == []
    cli.main(["report", "G", "--people", files["people"], "--logs", files["logs"], "--out", out,
              "--order", "numeric"])
    assert lines(spark, out) == ["2,Bob"]


def test_kmeans_then_silhouette(spark, files):
    out = os.path.join(files["dir"], "km")
    cli.main(["kmeans", "--points", files["points"], "--seeds", files["seeds"], "--out", out,
              "--max-iter", "5", "--assignments"])
    assert lines(spark, os.path.join(out, "final")) == ["0,0", "10,10"]
    assert "0,0\t1,0" in lines(spark, os.path.join(out, "final_clusters"))
    sil = os.path.join(files["dir"], "sil")
    cli.main(["silhouette", "--assignments", os.path.join(out, "final_clusters"), "--out", sil])
    mean = lines(spark, os.path.join(sil, "mean"))
    assert mean[0].startswith("Silhouette Coefficient for k = 2,0.9")


def test_kmeans_nd(spark, files):
    out = os.path.join(files["dir"], "nd")
    cli.main(["kmeans-nd", "--points", files["ndpoints"], "--seeds", files["ndseeds"], "--out", out,
              "--assignments"])
    got = lines(spark, os.path.join(out, "final_clusters"))
    assert "1,1.0,0.0,0.0,1" in got and len(got) == 4


def test_generate(spark, files):
    out = os.path.join(files["dir"], "gen")
    cli.main(["generate", "--n", "50", "--k", "3", "--out", out])
    assert len(lines(spark, os.path.join(out, "data_points"))) == 50
    assert len(lines(spark, os.path.join(out, "3seed_points"))) == 3


@pytest.mark.parametrize("letter,expected", [
    ("A", ["Ann,chess", "Cy,go"]),
    ("B", ["1,Ann,US", "2,Bob,FR"]),
    ("C", ["FR,1", "US,2"]),
    ("D", ["Ann,1", "Bob,2", "Cy,1"]),
    ("E", ["Ann,1,1", "Bob,1,1", "Cy,1,1"]),
    ("H", ["2,Bob,2"]),
])
def test_other_reports(spark, files, letter, expected):
    out = os.path.join(files["dir"], f"r{letter}")
    cli.main(["report", letter, "--people", files["people"], "--logs", files["logs"],
              "--associates", files["assoc"], "--out", out, "--k", "2", "--nationality", "US"])
    assert lines(spark, out) == expected


def test_trips(spark, files, capsys):
    hdr = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,pickup_longitude,"
           "pickup_latitude,RatecodeID,store_and_fwd_flag,dropoff_longitude,dropoff_latitude,payment_type,"
           "fare_amount,extra,mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount")
    rows = ["2,2016-03-07 06:00:00,2016-03-07 06:10:00,1,2.5,-73.9,40.7,1,N,-73.9,40.7,1,9,0.5,0.5,2,0,0.3,12",
            "2,2016-03-07 08:00:00,2016-03-07 08:00:30,2,1.0,-73.9,40.7,1,N,-73.9,40.7,2,5,0.5,0.5,0,0,0.3,6",
            "2,2016-03-07 09:00:00,2016-03-07 09:00:30,0,1.0,-73.9,40.7,1,N,-73.9,40.7,2,5,0.5,0.5,0,0,0.3,6"]
    p = write(os.path.join(files["dir"], "trips.csv"), hdr + "\n" + "\n".join(rows) + "\n")
    out = os.path.join(files["dir"], "trips_out")
    cli.main(["trips", "--input", p, "--out", out])
    got = lines(spark, os.path.join(out, "features"))
    assert got == ["1,2.5,-73.9,40.7,-73.9,40.7,1,0.0,12.0,0,23,600,1,0",
                   "2,1.0,-73.9,40.7,-73.9,40.7,2,0.0,6.0,0,1,30,0,1"]
    assert '"mean_card_tip": 2.0' in capsys.readouterr().out


def test_kmeans_reference_layout(spark, files):
    out = os.path.join(files["dir"], "km_ref")
    cli.main(["kmeans", "--points", files["points"], "--seeds", files["seeds"], "--out", out,
              "--max-iter", "5", "--layout", "reference"])
    assert lines(spark, os.path.join(out, "iteration_1")) == ["0,0", "10,10"]
    assert lines(spark, os.path.join(out, "iteration_2")) == ["0,0", "10,10"]
    assert not os.path.exists(os.path.join(out, "iteration_3"))      # converged at round 2


def test_report_counts_and_keeps_bad_lines(spark, files, capsys):
    import json
    d = tempfile.mkdtemp(prefix="tessera-cli-")
    people = write(os.path.join(d, "people.csv"), "1,Ann,US,1,chess\nx,Bob,FR,2,golf\n3,Cy,US\n")
    out = os.path.join(d, "F")
    cli.main(["report", "F", "--people", people, "--logs", files["logs"], "--associates", files["assoc"],
              "--out", out, "--quarantine", os.path.join(d, "bad")])
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert told["people"] == {"rows": 3, "missing field": 1, "extra field": 0, "bad value": 1}
    assert told["logs"] == {"rows": 3, "missing field": 0, "extra field": 0, "bad value": 0}
    assert lines(spark, os.path.join(d, "bad", "people")) == [
        "bad value\tid\tx,Bob,FR,2,golf", "missing field\tcountry_code;hobby\t3,Cy,US"]
    assert lines(spark, os.path.join(d, "bad", "logs")) == []
