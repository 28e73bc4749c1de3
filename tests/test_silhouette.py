import math
import random

import pytest

from pyspark.sql import functions as F

from tessera.functions.scalar import format4
from tessera.operators import silhouette as SIL


def frame(spark, rows):
    return spark.createDataFrame([(i, c, x, y) for i, (c, x, y) in enumerate(rows)],
                                 "pid long, pos int, x int, y int")


def brute(rows, mode="reference"):
    out = []
    for (c, x, y) in rows:
        own = [(x2, y2) for (c2, x2, y2) in rows if c2 == c]
        if mode == "reference":
            others = [p for p in own if p != (x, y)]
        else:
            others = list(own)
            others.remove((x, y))
        a = sum(math.dist((x, y), p) for p in others) / len(others) if others else 0.0
        bs = []
        for c2 in {r[0] for r in rows} - {c}:
            pts = [(x2, y2) for (cc, x2, y2) in rows if cc == c2]
            bs.append(sum(math.dist((x, y), p) for p in pts) / len(pts))
        if not bs:
            out.append(None)
            continue
        b = min(bs)
        if mode == "textbook" and len(own) == 1:
            out.append(0.0)
        else:
            out.append((b - a) / max(a, b))
    return out


def test_hand_case(spark):
    rows = [(0, 0, 0), (0, 0, 2), (1, 10, 0)]
    got = {r["pid"]: r["silhouette"] for r in SIL.silhouette_points(frame(spark, rows)).collect()}
    assert got[0] == pytest.approx(0.8) and got[1] == pytest.approx(0.803884, abs=1e-6)
    assert got[2] == pytest.approx(1.0)
    mean = SIL.silhouette_mean(frame(spark, rows))
    m = mean.first()
    assert m["mean_silhouette"] == pytest.approx(0.867961, abs=1e-6) and m["clusters"] == 2
    assert mean.select(format4(F.col("mean_silhouette"))).first()[0] == "0.8680"


def test_several_clusterings_in_one_job(spark):
    rng = random.Random(6)
    runs = {r: [(rng.randrange(2 + r), rng.randrange(12), rng.randrange(12)) for _ in range(30 + 40 * r)] for r in range(3)}
    runs[7] = [(4, 1, 1), (4, 2, 2)]                       # a single cluster
    df = spark.createDataFrame([(r, *row) for r, rows in runs.items() for row in rows], "job int, pos int, x int, y int")
    for block_rows in (None, 9):
        got = {m["run"]: m for m in SIL.silhouette_mean(df, run="job", block_rows=block_rows).collect()}
        assert got.keys() == runs.keys()
        for r, rows in runs.items():
            want = [v for v in brute(rows) if v is not None]
            assert got[r]["points"] == len(rows) and got[r]["clusters"] == len({c for c, _, _ in rows})
            assert got[r]["mean_silhouette"] == (pytest.approx(sum(want) / len(want)) if want else None)


def test_duplicates_reference_and_textbook(spark):
    rows = [(0, 0, 0), (0, 0, 0), (0, 0, 2), (1, 10, 0)]
    ref = {r["pid"]: r["silhouette"] for r in SIL.silhouette_points(frame(spark, rows)).collect()}
    assert ref[0] == pytest.approx(0.8) and ref[1] == pytest.approx(0.8)
    assert ref[2] == pytest.approx(0.803884, abs=1e-6)
    tb = {r["pid"]: r["silhouette"] for r in SIL.silhouette_points(frame(spark, rows), mode="textbook").collect()}
    assert tb[0] == pytest.approx(0.9) and tb[1] == pytest.approx(0.9)


def test_single_cluster_is_null(spark):
    rows = [(0, 0, 0), (0, 3, 4)]
    assert all(r["silhouette"] is None for r in SIL.silhouette_points(frame(spark, rows)).collect())


@pytest.mark.parametrize("block_rows", [1, 3, 1024])
@pytest.mark.parametrize("mode", ["reference", "textbook"])
def test_blocked_equals_brute_force(spark, block_rows, mode):
    rnd = random.Random(11)
    rows = []
    for _ in range(60):
        c = rnd.randint(0, 3)
        rows.append((c, rnd.randint(0, 20) + 30 * c, rnd.randint(0, 20)))
    rows += [rows[0]] * 5                      # a hot coordinate
    want = brute(rows, mode)
    got = {r["pid"]: r["silhouette"]
           for r in SIL.silhouette_points(frame(spark, rows), mode=mode, block_rows=block_rows).collect()}
    for i, w in enumerate(want):
        assert got[i] == pytest.approx(w, abs=1e-9)


def test_rows_with_nulls_are_skipped(spark):
    rows = [(0, 0, 0), (0, 0, 2), (1, 10, 0)]
    want = {r["pid"]: r["silhouette"] for r in SIL.silhouette_points(frame(spark, rows)).collect()}
    more = frame(spark, rows + [(0, None, 5), (None, 1, 1), (1, 2, None)])
    got = {r["pid"]: r["silhouette"] for r in SIL.silhouette_points(more).collect()}
    assert got == want | {3: None, 4: None, 5: None}
    m = SIL.silhouette_mean(more).first()
    assert (m["clusters"], m["points"]) == (2, 3) and abs(m["mean_silhouette"] - 0.867961) < 1e-6


def test_coordinate_shared_by_two_lone_clusters(spark):
    got = SIL.silhouette_points(frame(spark, [(0, 5, 5), (1, 5, 5)])).collect()
    assert [r["silhouette"] for r in got] == [None, None]


def test_runs_away_from_the_repository(tmp_path):
    """Python workers started in another folder, without PYTHONPATH."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
from tessera.session import build_session
from tessera.operators.silhouette import silhouette_mean
s = build_session("local[2]", 2)
df = s.createDataFrame([(0, 0, 0), (0, 0, 2), (1, 10, 0)], "pos int, x int, y int")
print("MEAN", round(silhouette_mean(df).first()["mean_silhouette"], 6))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "MEAN 0.867961" in out.stdout, out.stderr[-2000:]


def brute_sums(qx, qy, rx, ry, rw):
    return [sum(w * math.hypot(x - a, y - b) for a, b, w in zip(rx.tolist(), ry.tolist(), rw.tolist()))
            for x, y in zip(qx.tolist(), qy.tolist())]


@pytest.mark.parametrize("xs, step, ys, hot", [(3, 400, 2000, 1), (60, 1, 60, 1), (2, 7, 20_000, 10 ** 9), (4, -3, 1500, 40)])
def test_filled_columns_are_not_computed_pair_by_pair(monkeypatch, xs, step, ys, hot):
    import numpy as np

    rng = np.random.default_rng(xs)
    pts = np.array([(x * step, y - ys // 3) for x in range(xs) for y in range(ys)], np.int64)
    r = pts[rng.permutation(len(pts))[:3000]]
    w = rng.integers(1, 20, len(r))
    w[5] = hot
    q = pts[rng.permutation(len(pts))[:3000]]
    pairs, direct = [], SIL._direct_sums
    monkeypatch.setattr(SIL, "_direct_sums", lambda *a: pairs.append(len(a[0]) * len(a[2])) or direct(*a))
    got = SIL.distance_sums(q[:, 0], q[:, 1], r[:, 0], r[:, 1], w)
    assert sum(pairs) < len(q) * len(r) / 100
    some = rng.permutation(len(q))[:40]
    assert got[some] == pytest.approx(brute_sums(q[some, 0], q[some, 1], r[:, 0], r[:, 1], w), rel=1e-11)
    monkeypatch.setattr(SIL, "COLUMN_DOUBLES", 1)          # one column at a time
    assert SIL.distance_sums(q[:, 0], q[:, 1], r[:, 0], r[:, 1], w) == pytest.approx(got, rel=1e-11)


def test_sparse_columns_and_far_coordinates_are_computed_pair_by_pair():
    import numpy as np

    rng = np.random.default_rng(2)
    for span in (100_000, 1 << 40):
        x, y = rng.integers(-span, span, (2, 1100))
        got = SIL.distance_sums(x[:20], y[:20], x, y, np.ones(1100, np.int64))
        assert got == pytest.approx(brute_sums(x[:20], y[:20], x, y, np.ones(1100)), rel=1e-12)
        assert (SIL.distance_sums(x, y, x, y, np.ones(1100, np.int64))[:20] == got).all()


def test_mean_over_a_filled_grid(spark):
    rows = [(x // 4, x * 50, y) for x in range(8) for y in range(1500) if (x * y) % 7 < 6]
    m = SIL.silhouette_mean(frame(spark, rows)).first()
    few = SIL.silhouette_mean(frame(spark, rows), block_rows=300).first()      # every cell below the least number of pairs
    assert m["points"] == few["points"] == len(rows)
    assert m["mean_silhouette"] == pytest.approx(few["mean_silhouette"], rel=1e-10)
