import math
import random

import pytest

from tessera.operators import kmeans as K


def pts(spark, xy):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "pid long, x int, y int")


def test_step_truncates_and_converges(spark):
    p = pts(spark, [(0, 0), (1, 0), (10, 10), (11, 10)])
    res = K.fit2d(p, [(0, 0), (10, 10)], 1, early_stop=False)
    assert res.centroids == [(0, 0), (10, 10)] and res.converged
    assert res.sizes == [2, 2]


def test_tie_goes_to_first_seed_and_cluster_vanishes(spark):
    p = pts(spark, [(5, 0)])
    cur, sizes = K.step2d(p, [(0, 0), (10, 0)])
    assert cur == [(5, 0)] and sizes == [1]


def test_equal_seeds_leave_one_centroid(spark):
    p = pts(spark, [(1, 1), (3, 3)])
    cur, _ = K.step2d(p, [(0, 0), (0, 0)])
    assert cur == [(2, 2)]


def test_next_round_order_is_text_of_old_centroid(spark):
    # old centroids (10,0) and (9,0): text "10,0" < "9,0"
    p = pts(spark, [(10, 0), (11, 0), (8, 0), (9, 0)])
    cur, _ = K.step2d(p, [(9, 0), (10, 0)])
    # (9,0) collects 8 and 9 -> 8; (10,0) collects 10, 11 -> 10; ordered by "10,0" < "9,0"
    assert cur == [(10, 0), (8, 0)]


def test_truncation_toward_zero():
    assert K._trunc_div(-7, 2) == -3 and K._trunc_div(7, 2) == 3


def test_negative_coordinates_truncate_like_java(spark):
    p = pts(spark, [(-7, 0), (0, 0)])
    cur, _ = K.step2d(p, [(0, 0)])
    assert cur == [(-3, 0)]


def test_any_or_all():
    prev = [(1, [0.0, 0.0]), (2, [9.0, 9.0])]
    cur = [(1, [0.0, 0.0]), (2, [5.0, 5.0])]
    assert K.converged_nd(prev, cur, 0.01, "any")
    assert not K.converged_nd(prev, cur, 0.01, "all")


def test_nd_id_text_order_breaks_ties(spark):
    # point at the origin is equally near to ids 2 and 10; "10" sorts first
    p = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 0.0]), (2, [-2.0, 0.0])], "pid long, coords array<double>")
    cur, sizes = K.step_nd(p, [(2, [-1.0, 0.0]), (10, [1.0, 0.0])], 2)
    # round 1 keeps seed order: id 2 first, so the origin goes to id 2
    assert dict(zip([c for c, _ in cur], sizes)) == {2: 2, 10: 1}
    assert [c for c, _ in cur] == [10, 2]          # next-round order
    cur2, sizes2 = K.step_nd(p, [(10, [1.0, 0.0]), (2, [-1.0, 0.0])], 2)
    assert dict(zip([c for c, _ in cur2], sizes2)) == {10: 2, 2: 1}


def test_nd_skips_other_dimensions(spark):
    p = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0, 2.0]), (2, [1.0])], "pid long, coords array<double>")
    res = K.fit_nd(p, [(1, [0.0, 0.0])], 2)
    assert res.sizes == [2] and res.centroids == [(1, [1.0, 1.0])]
    assert (res.points, res.skipped) == (3, 1)


def test_null_points_are_counted_as_skipped(spark):
    p = spark.createDataFrame([(0, 0, 0), (1, None, 3), (2, 2, 2)], "pid long, x int, y int")
    res = K.fit2d(p, [(0, 0)], 1, early_stop=False)
    assert (res.points, res.skipped) == (3, 1) and res.sizes == [2]


def _brute_round(xy, cents):
    groups = {}
    for x, y in xy:
        d = [(x - cx) ** 2 + (y - cy) ** 2 for cx, cy in cents]
        i = d.index(min(d))
        groups.setdefault(i, []).append((x, y))
    out = []
    for i, g in groups.items():
        sx, sy, n = sum(p[0] for p in g), sum(p[1] for p in g), len(g)
        out.append((f"{cents[i][0]},{cents[i][1]}".encode(), (K._trunc_div(sx, n), K._trunc_div(sy, n)), n))
    out.sort()
    return [o[1] for o in out], [o[2] for o in out]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_rounds_match_brute_force_for_any_partitioning(spark, parts):
    rnd = random.Random(5)
    xy = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(300)] + [(7, 7)] * 40
    p = pts(spark, xy).repartition(parts)
    seeds = [xy[i] for i in range(6)]
    cur, sizes = K.step2d(K.weighted_coordinates(p), seeds, weight="w")
    assert (cur, sizes) == _brute_round(xy, seeds)
    res = K.fit2d(p, seeds, 30)
    assert sum(res.sizes) == len(xy)
    prev = seeds
    for it in range(res.iterations):
        prev, _ = _brute_round(xy, prev)
    assert prev == res.centroids


def test_assignment_is_nearest(spark):
    rnd = random.Random(9)
    xy = [(rnd.randint(0, 100), rnd.randint(0, 100)) for _ in range(200)]
    cents = [(10, 10), (50, 50), (90, 10), (10, 90)]
    a = K.assign2d(pts(spark, xy), cents).collect()
    for r in a:
        d = [(r["x"] - cx) ** 2 + (r["y"] - cy) ** 2 for cx, cy in cents]
        assert r["pos"] == d.index(min(d)) and (r["cx"], r["cy"]) == cents[r["pos"]]


def test_many_centroids_use_array_path(spark):
    rnd = random.Random(3)
    xy = [(rnd.randint(0, 1000), rnd.randint(0, 1000)) for _ in range(300)]
    cents = [(i * 10, i * 7) for i in range(70)]          # above the unroll limit
    cur, sizes = K.step2d(pts(spark, xy), cents)
    assert (cur, sizes) == _brute_round(xy, cents)


def test_fixed_rounds_check_only_last_two(spark):
    p = pts(spark, [(0, 0), (1, 0), (10, 10), (11, 10)])
    res = K.fit2d(p, [(0, 0), (1, 0)], 3, early_stop=False)
    assert res.iterations == 3 and res.converged and len(res.history) == 3


def test_null_points_are_not_assigned(spark):
    p = spark.createDataFrame([(0, 0, 0), (1, None, 5), (2, 3, None)], "pid long, x int, y int")
    assert [r["pid"] for r in K.assign2d(p, [(0, 0), (9, 9)]).collect()] == [0]


def test_null_elements_are_skipped_nd(spark):
    p = spark.createDataFrame([([0.0, 0.0],), ([2.0, None],), ([4.0, 0.0],), (None,), ([1.0],)], "coords array<double>")
    res = K.fit_nd(p, [(1, [0.0, 0.0])], 1, early_stop=False)
    assert (res.points, res.skipped, res.centroids) == (5, 3, [(1, [2.0, 0.0])])
    assert K.assign_nd(p, res.centroids).count() == 2


def test_many_centroids_nd(spark):
    rng = random.Random(4)
    rows = [[rng.random() for _ in range(8)] for _ in range(1500)]
    cents = [(i, [rng.random() for _ in range(8)]) for i in range(500)]
    got, sizes = K.step_nd(spark.createDataFrame([(r,) for r in rows], "coords array<double>"), cents, 8)
    want = {}
    for r in rows:
        best = min(cents, key=lambda c: (math.dist(r, c[1]), c[0]))[0]
        want.setdefault(best, []).append(r)
    assert {c: n for (c, _), n in zip(got, sizes)} == {c: len(v) for c, v in want.items()}
    for c, v in got:
        assert all(abs(a - sum(col) / len(col)) < 1e-12 for a, col in zip(v, zip(*want[c])))


def test_vector_sums_come_as_one_row_per_centroid(spark, monkeypatch):
    """k = 500, d = 256: k rows, whether partial sums meet in one step or two."""
    import numpy as np
    rng = np.random.default_rng(5)
    k, d, tasks = 500, 256, 12
    want = np.zeros((k, d))
    rows = []
    for t in range(tasks):
        for i in range(k):
            if rng.random() < 0.2 or t == i % tasks:
                v = rng.random(d)
                want[i] += v
                rows.append((i, 1 + t, v.tolist()))
    parts = spark.createDataFrame(rows, "pos int, n long, sums array<double>").repartition(tasks).cache()
    for bound in (1024, 4):
        monkeypatch.setattr(K, "MERGE_ROWS", bound)
        got = K.vector_sums(parts, tasks).collect()
        assert sorted(r["pos"] for r in got) == list(range(k))
        assert sum(r["n"] for r in got) == sum(r[1] for r in rows)
        for r in got:
            assert np.allclose(r["sums"], want[r["pos"]], rtol=1e-12)
    parts.unpersist()
