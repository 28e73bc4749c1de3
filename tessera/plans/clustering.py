"""k-means jobs over the stand-in points (customer -> 2-D, embeddings -> N-D).

Parameters mirror the reference runs: one step with k=10; 30 fixed rounds
with k=15; early stop with k=20 and up to 50 rounds; early stop with k=10
and up to 90 rounds (the partial-sum job: Spark's partial aggregation is the
combiner); final assignment with k=20; N-D with up to 20 rounds and
threshold 0.01; silhouette of the k=10 assignment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import format4
from tessera.operators import kmeans as K
from tessera.operators import silhouette as SIL
from tessera.sources import generate as G
from tessera.sources import standins as S

from tessera.fixed import (ASSIGN_K, ASSIGN_R, CONV_K, CONV_R, FIXED_K, FIXED_R, PARTIAL_K,  # noqa: E402
                           PARTIAL_R, ROUNDS_ND, SILHOUETTE_K, STEP_K, THRESHOLD_2D, THRESHOLD_ND)
from tessera.fixed import SWEEP_K as FIXED_SWEEP_K  # noqa: E402
from tessera.fixed import SWEEP_R as FIXED_SWEEP_R  # noqa: E402

# History is shown for the fixed-rounds run; the silhouette scores the k=10
# clustering after the early-stop limit.  The N-D stand-in has 64 dimensions
# and uses 8 seeds (the reference's N-D seed file is not published).
HISTORY_K, HISTORY_R = FIXED_K, FIXED_R
ND_K, ND_R, ND_DIM, ND_THRESHOLD = 8, ROUNDS_ND, 64, THRESHOLD_ND
SIL_K, SIL_R = SILHOUETTE_K, CONV_R


def fit_points2d(spark: SparkSession, d: str, k: int, rounds: int, early_stop: bool = True):
    pts = S.points2d(spark, d)
    return pts, K.fit2d(pts, S.seeds2d(pts, k), rounds, THRESHOLD_2D, early_stop)


def kmeans_step(spark, d, k: int = STEP_K) -> DataFrame:
    """One round, and whether it moved any centroid (seeds vs result)."""
    _, res = fit_points2d(spark, d, k, 1, early_stop=False)
    return K.centroids_frame2d(spark, res)


def kmeans_fixed_rounds(spark, d, k: int = FIXED_K, rounds: int = FIXED_R) -> DataFrame:
    """R rounds; converged compares the last two rounds only."""
    _, res = fit_points2d(spark, d, k, rounds, early_stop=False)
    return K.centroids_frame2d(spark, res)


def kmeans_converged(spark, d, k: int = CONV_K, rounds: int = CONV_R) -> DataFrame:
    """Rounds until converged (tested from round 2) or R."""
    _, res = fit_points2d(spark, d, k, rounds)
    return K.centroids_frame2d(spark, res)


def kmeans_partial_sums(spark, d, k: int = PARTIAL_K, rounds: int = PARTIAL_R) -> DataFrame:
    """C4: the same job with map-side partial sums (built into Spark's aggregate)."""
    return kmeans_converged(spark, d, k, rounds)


def final_assignments(spark, d, k: int, rounds: int) -> DataFrame:
    pts, res = fit_points2d(spark, d, k, rounds)
    return K.assign2d(pts, res.centroids).select(
        "pid", "x", "y", "pos", F.col("cx").cast("int").alias("cx"), F.col("cy").cast("int").alias("cy"))


def kmeans_assignments(spark, d, k: int = ASSIGN_K, rounds: int = ASSIGN_R) -> DataFrame:
    """(pid, x, y, pos, cx, cy) with the final centroids."""
    return final_assignments(spark, d, k, rounds)


def kmeans_history(spark, d, k: int = HISTORY_K, rounds: int = HISTORY_R) -> DataFrame:
    """(iteration, pos, x, y) of every round."""
    _, res = fit_points2d(spark, d, k, rounds, early_stop=False)
    return K.history_frame2d(spark, res)


def weighted_assignments(spark, d, k: int, rounds: int) -> DataFrame:
    """(x, y, w, pos, cx, cy): the distinct coordinates, each once with its
    number of points, and their final centroids."""
    pts, res = fit_points2d(spark, d, k, rounds)
    return K.assign2d(K.weighted_coordinates(pts), res.centroids).select(
        "x", "y", "w", "pos", F.col("cx").cast("int").alias("cx"), F.col("cy").cast("int").alias("cy"))


def cluster_profile(spark, d, k: int = SIL_K, rounds: int = SIL_R) -> DataFrame:
    """Points and distinct coordinates per final cluster."""
    a = weighted_assignments(spark, d, k, rounds)
    return a.groupBy("pos", "cx", "cy").agg(F.sum("w").alias("points"), F.count(F.lit(1)).alias("distinct_points"))


def kmeans_nd(spark, d, k: int = ND_K, rounds: int = ND_R, threshold: float = ND_THRESHOLD,
              criterion: str = "any") -> DataFrame:
    """N-D k-means on the embeddings; ids are the seed vec_ids."""
    pts = S.points_nd(spark, d)
    res = K.fit_nd(pts, S.seeds_nd(pts, k), rounds, threshold, criterion, early_stop=True)
    return K.centroids_frame_nd(spark, res)


def kmeans_nd_step(spark, d, k: int = ND_K) -> DataFrame:
    """C7 mode a: one N-D round (no convergence test before round 2)."""
    pts = S.points_nd(spark, d)
    res = K.fit_nd(pts, S.seeds_nd(pts, k), 1, ND_THRESHOLD, "any", early_stop=False)
    return K.centroids_frame_nd(spark, res)


def kmeans_nd_fixed(spark, d, k: int = ND_K, rounds: int = ND_R) -> DataFrame:
    """C7 mode b: all rounds run; the flag records whether any round from the
    second on converged."""
    pts = S.points_nd(spark, d)
    res = K.fit_nd(pts, S.seeds_nd(pts, k), rounds, ND_THRESHOLD, "any", early_stop=False)
    return K.centroids_frame_nd(spark, res)


def kmeans_nd_assignments(spark, d, k: int = ND_K, rounds: int = ND_R) -> DataFrame:
    """C7 mode eii: (pid, cid) of every point with the final centroids."""
    pts = S.points_nd(spark, d)
    res = K.fit_nd(pts, S.seeds_nd(pts, k), rounds, ND_THRESHOLD, "any", early_stop=True)
    return K.assign_nd(pts, res.centroids).select("pid", "cid")


def kmeans_nd_history(spark, d, k: int = ND_K, rounds: int = ND_R) -> DataFrame:
    """C10 in N-D: (iteration, cid, dim, value) of every round up to the stop."""
    pts = S.points_nd(spark, d)
    return K.history_frame_nd(spark, K.fit_nd(pts, S.seeds_nd(pts, k), rounds, ND_THRESHOLD, "any", early_stop=True))


def kmeans_nd_all(spark, d) -> DataFrame:
    """C7 with every centroid required to be settled."""
    return kmeans_nd(spark, d, criterion="all")


def silhouette_points(spark, d, k: int = SIL_K, rounds: int = SIL_R, mode: str = "reference") -> DataFrame:
    """C8 per point: (pid, x, y, pos, silhouette) of the final k-means clustering."""
    a = final_assignments(spark, d, k, rounds)
    return SIL.silhouette_points(a, "pos", "x", "y", mode).select(
        "pid", "x", "y", "pos", F.round("silhouette", 6).alias("silhouette"))


def silhouette_mean(spark, d, k: int = SIL_K, rounds: int = SIL_R, mode: str = "reference") -> DataFrame:
    """C8 mean: (clusters, points, mean_silhouette, mean_text '%.4f')."""
    a = weighted_assignments(spark, d, k, rounds)
    m = SIL.silhouette_mean(a, "pos", "x", "y", mode, weight="w")
    return m.select("clusters", "points", F.round("mean_silhouette", 6).alias("mean_silhouette"),
                    format4(F.col("mean_silhouette")).alias("mean_text"))


def silhouette_mean_textbook(spark, d) -> DataFrame:
    return silhouette_mean(spark, d, mode="textbook")


SWEEP_K, SWEEP_R = FIXED_SWEEP_K, FIXED_SWEEP_R


def kmeans_sweep(spark, d, ks=SWEEP_K, rounds=SWEEP_R) -> DataFrame:
    """(k, max_iter, iterations, converged, clusters, mean_silhouette) for
    every k and round limit.  The weighted points are prepared once; one
    early-stop run per k goes up to the largest limit (a smaller limit is a
    prefix of it: rounds are deterministic).  All runs share each round's job,
    and the distinct final rounds are scored by one silhouette job over all
    their clusterings."""
    pts = S.points2d(spark, d)
    prepared = K.prepare2d(pts)
    seeds = S.seeds2d(pts, max(ks))        # the first k of them are the seeds of a smaller k
    try:
        fits = K.fit_runs2d(prepared, {k: seeds[:k] for k in ks}, max(rounds), THRESHOLD_2D, early_stop=True)
        # same final round -> same clustering -> same silhouette
        last = {(k, r): min(fits[k].iterations, r) for k in ks for r in rounds}
        runs = sorted({(k, i) for (k, _), i in last.items()})
        scored = None
        for n, (k, i) in enumerate(runs):
            one = K.assign2d(prepared, fits[k].history[i - 1][1]).select(F.lit(n).alias("run"), "pos", "x", "y", "w")
            scored = one if scored is None else scored.unionByName(one)
        means = {runs[m["run"]]: m for m in SIL.silhouette_mean(scored, weight="w", run="run").collect()}
        rows = []
        for (k, r), i in last.items():
            m = means.get((k, i))          # none without points
            rows.append((k, r, i, fits[k].converged and fits[k].iterations <= r,
                         m["clusters"] if m else 0, m["mean_silhouette"] if m else None))
    finally:
        prepared.unpersist()
    out = spark.createDataFrame(
        rows, "k int, max_iter int, iterations int, converged boolean, clusters int, mean_silhouette double")
    return out.select("k", "max_iter", "iterations", "converged", "clusters",
                      F.round("mean_silhouette", 6).alias("mean_silhouette"))


def generate_points(spark, d, seed: int = 7) -> DataFrame:
    """G1: one seeded random point (0..10000 both axes) per customer key."""
    return G.points_from_keys(S.table(spark, d, "customer").select("c_custkey"), "c_custkey", seed)


def generate_seeds(spark, d, k: int = FIXED_K, seed: int = 8) -> DataFrame:
    """G1 seeds: the points of another seed, of the k smallest customer keys."""
    return S.first_points(generate_points(spark, d, seed), k)
