"""The nearest-centroid kernel, its bounds, and rounds that share a job."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import geometry as G
from tessera.operators import kmeans as K
from tessera.operators import silhouette as SIL
from tessera.plans import clustering as C
from tessera.sources import standins as S

SF = "/root/testdata/sf0.01"


def brute(x, y, cx, cy):
    return ((x[:, None] - cx) ** 2 + (y[:, None] - cy) ** 2).argmin(axis=1)      # first of equal ones


coordinate = st.integers(-6, 6)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(coordinate, coordinate), min_size=1, max_size=200),
       st.lists(st.tuples(coordinate, coordinate), min_size=1, max_size=12))
def test_nearest_with_ties(points, centroids):
    x, y = np.array(points, np.int64).T
    cx, cy = np.array(centroids, np.int64).T
    assert (G.nearest(x, y, cx, cy) == brute(x, y, cx, cy)).all()
    only, pos, _ = G.nearest_in(G.Boxes(x, y), cx, cy)      # any order of points
    assert (pos == brute(x, y, cx, cy)).all()


def test_thousands_of_centroids(spark):
    rng = np.random.default_rng(3)
    xy = rng.integers(0, 10_001, (6000, 2))
    cents = [tuple(int(v) for v in c) for c in rng.integers(0, 10_001, (2000, 2))]
    cx, cy = np.array(cents).T
    want = brute(xy[:, 0], xy[:, 1], cx, cy)
    pts = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(xy)], "pid long, x int, y int")
    got = {r["pid"]: (r["pos"], (r["cx"], r["cy"])) for r in K.assign2d(pts, cents).collect()}
    assert got == {i: (int(p), cents[p]) for i, p in enumerate(want)}
    prepared = K.prepare2d(pts)
    try:
        cur, sizes, computed = K.step_runs(prepared, {0: cents}, weight="w", tasks=8)[0]
        assert (cur, sizes) == K.step2d(pts, cents) and sum(sizes) == 6000
        assert computed < 6000 * 2000 / 4
    finally:
        prepared.unpersist()


def test_far_coordinates_are_refused():
    with pytest.raises(OverflowError):
        G.Boxes(np.array([1 << 30]), np.array([0]))
    x = np.array([(1 << 30) - 1, -(1 << 30) + 1])
    assert list(G.nearest(x, x, x[::-1].copy(), x[::-1].copy())) == [1, 0]


def test_morton_codes_agree(spark):
    rows = [(x, y) for x in (-7, 0, 3, 10_000) for y in (-1, 5, 9_999)]
    df = spark.createDataFrame(rows, "x int, y int")
    from pyspark.sql import functions as F
    got = [r["m"] for r in df.select(G.morton(F.col("x"), F.col("y")).alias("m")).collect()]
    x, y = np.array(rows, np.int64).T
    assert got == G.morton_codes(x, y).tolist()


def test_bounds_leave_out_most_distances(spark):
    """kmeans_partial_sums: a third of the distances at most, over all rounds."""
    pts = S.points2d(spark, "/root/testdata/sf0.1")
    res = K.fit2d(pts, S.seeds2d(pts, C.PARTIAL_K), C.PARTIAL_R)
    points = K.weighted_coordinates(pts).count()
    assert len(res.computed) == res.iterations
    assert 3 * sum(res.computed) <= points * C.PARTIAL_K * res.iterations


def test_runs_share_the_jobs_of_a_round(spark):
    pts = S.points2d(spark, SF)
    seeds = S.seeds2d(pts, 20)
    one = {k: K.fit2d(pts, seeds[:k], 90) for k in (5, 10, 20)}
    prepared = K.prepare2d(pts)
    spark.sparkContext.setJobGroup("rounds", "rounds")
    try:
        prepared.count()
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
        fits = K.fit_runs2d(prepared, {k: seeds[:k] for k in (5, 10, 20)}, 90)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        prepared.unpersist()
    assert jobs == max(f.iterations for f in fits.values())
    for k, f in fits.items():
        assert (f.centroids, f.sizes, f.history, f.converged) == (
            one[k].centroids, one[k].sizes, one[k].history, one[k].converged)


def test_silhouette_skips_clusters(spark):
    """On the job's own clustering most (coordinate, cluster) cells are left
    out; the rows stay those of brute force."""
    a = C.weighted_assignments(spark, SF, 10, 50)
    W = SIL.coordinate_weights(a, weight="w").cache()
    stats = SIL._numbered(W, [], None, 8)
    coords = W.join(stats.select("cid", "cluster"), "cluster").select("cid", "x", "y", "w")
    needs = SIL.needed_clusters(coords, stats)
    cells, kept = W.count() * 10, needs.count()
    assert needs.where("cid = rcid").count() == W.count()
    assert kept <= 0.5 * cells
    # whatever is left out has a larger mean than what is kept
    rows = [(r["cluster"], float(r["x"]), float(r["y"]), r["w"]) for r in W.collect()]
    of = {}
    for c, x, y, w in rows:
        of.setdefault(c, []).append((x, y, w))
    ids = {r["cid"]: r["cluster"] for r in stats.collect()}
    kept_of = {}
    for r in needs.collect():
        kept_of.setdefault((ids[r["cid"]], float(r["x"]), float(r["y"])), set()).add(ids[r["rcid"]])
    for c, x, y, _ in random.Random(1).sample(rows, 60):
        mean = {o: sum(w * ((x - u) ** 2 + (y - v) ** 2) ** .5 for u, v, w in p) / sum(w for *_, w in p)
                for o, p in of.items() if o != c}
        assert min(mean, key=mean.get) in kept_of[c, x, y]
    W.unpersist()


def test_many_clusters_need_no_table(spark, monkeypatch):
    """Above the bound of the broadcast table every cluster is met."""
    rng = random.Random(2)
    rows = [(i % 2, rng.randrange(6), rng.randrange(20), rng.randrange(20)) for i in range(120)]
    df = spark.createDataFrame(rows, "job int, pos int, x int, y int")
    want = {tuple(r) for r in SIL.silhouette_coordinates(df, run="job").collect()}
    one = {tuple(r) for r in SIL.silhouette_coordinates(df).collect()}
    monkeypatch.setattr(SIL, "MAX_BROADCAST_CLUSTERS", 3)
    close = lambda a, b: all(u == v or abs(u - v) < 1e-12 for u, v in zip(a, b))
    for expected, got in ((want, SIL.silhouette_coordinates(df, run="job").collect()),
                          (one, SIL.silhouette_coordinates(df).collect())):
        assert len(expected) == len(got)
        assert all(close(a, b) for a, b in zip(sorted(expected), sorted(map(tuple, got))))
