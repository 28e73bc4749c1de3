"""Command line: run a job on delimited files, the way the reference is used.

    python -m tessera report unvisited_friends --people P --logs L --associates A --out DIR
    python -m tessera kmeans --points P --seeds S --out DIR --max-iter 50 [--fixed] [--assignments]
    python -m tessera kmeans-nd --points P --seeds S --out DIR --max-iter 20 --threshold 0.01
    python -m tessera silhouette --assignments DIR --out DIR [--mode textbook]
    python -m tessera trips --input trips.csv --out DIR
    python -m tessera generate --n 5000 --k 10 --out DIR

A report prints how many lines of each input it read and how many did not fit,
by reason; ``--quarantine DIR`` keeps those.  Outputs are headerless comma separated text; k-means writes the centroids
of every round under ``rounds/iteration=i`` (or, with ``--layout reference``,
one ``iteration_<i>`` folder per round), the final centroids under ``final``
and, with ``--assignments``, ``final_clusters`` as ``cx,cy<TAB>x,y`` lines.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tessera.fixed import (CONV_R, GENERATED_POINTS, LATEST_ACCESS_MIN, NATIONALITY, ROUNDS_ND, THRESHOLD_2D,
                           THRESHOLD_ND, TOP_PAGES)
from tessera.functions.scalar import format4
from tessera.operators import kmeans as K
from tessera.operators import silhouette as SIL
from tessera.plans import reports as R
from tessera.plans import trips as T
from tessera.session import build_session
from tessera.sources import delimited as D
from tessera.sources import generate as G

REPORTS = {
    "nationality_people": ("A", ["people"]),
    "top_pages": ("B", ["people", "logs"]),
    "people_per_nationality": ("C", ["people"]),
    "relationship_degree": ("D", ["people", "associates"]),
    "access_profile": ("E", ["people", "logs"]),
    "unvisited_friends": ("F", ["people", "associates", "logs"]),
    "latest_access": ("G", ["people", "logs"]),
    "above_average_degree": ("H", ["people", "associates"]),
}


def _session(args) -> SparkSession:
    if args.master:
        return build_session(args.master, args.shuffle_partitions)
    spark = SparkSession.builder.getOrCreate()
    return spark


def run_report(spark, args) -> None:
    name = {v[0]: k for k, v in REPORTS.items()}.get(args.name.upper(), args.name)
    schemas = {"people": D.PEOPLE, "logs": D.LOGS, "associates": D.ASSOCIATES}
    files = {k: D.checked(spark, getattr(args, k), schemas[k]) for k in REPORTS[name][1]}
    ins = {k: f.rows for k, f in files.items()}
    if name == "nationality_people":
        out = R.nationality_people(ins["people"], args.nationality)
    elif name == "top_pages":
        out = R.top_pages(ins["people"], ins["logs"], args.k)
    elif name == "latest_access":
        out = R.latest_access(ins["people"], ins["logs"], args.threshold, args.order, args.keep)
    else:
        out = getattr(R, name)(*[ins[k] for k in REPORTS[name][1]])
    D.write_delimited(out, args.out)
    if not args.unchecked:
        print(json.dumps({k: f.check(args.quarantine and f"{args.quarantine}/{k}") for k, f in files.items()}))


def run_kmeans(spark, args) -> None:
    pts = D.read_points2d(spark, args.points)
    seeds = D.read_seeds2d(spark, args.seeds)
    res = K.fit2d(pts, seeds, args.max_iter, args.threshold, early_stop=not args.fixed)
    hist = K.history_frame2d(spark, res).select("iteration", "x", "y")
    _write_rounds(hist, args.out, args.layout, res.iterations)
    D.write_delimited(K.centroids_frame2d(spark, res).select("x", "y"), f"{args.out}/final")
    if args.assignments:
        D.write_assignments2d(K.assign2d(pts, res.centroids), f"{args.out}/final_clusters",
                              grouped=args.grouped)
    print(json.dumps({"iterations": res.iterations, "converged": res.converged, "k": len(res.centroids),
                      "points": res.points, "skipped": res.skipped, "skipped_seeds": seeds.skipped}))


def run_kmeans_nd(spark, args) -> None:
    pts = D.read_points_nd(spark, args.points)
    seeds = D.read_seeds_nd(spark, args.seeds)
    res = K.fit_nd(pts, seeds, args.max_iter, args.threshold, args.criterion, early_stop=not args.fixed)
    rows = [(it, cid, *v) for it, cents in res.history for cid, v in cents]
    _write_rounds(K.wide_frame_nd(spark, rows, ["iteration", "cid"]), args.out, args.layout, res.iterations)
    D.write_delimited(K.wide_frame_nd(spark, [(cid, *v) for cid, v in res.centroids], ["cid"]).coalesce(1),
                      f"{args.out}/final")
    if args.assignments:
        a = K.assign_nd(pts, res.centroids)
        line = F.concat_ws(",", F.col("cid").cast("string"), F.array_join(F.col("coords").cast("array<string>"), ","),
                           F.lit("1"))
        a.select(line.alias("value")).write.mode("overwrite").text(f"{args.out}/final_clusters")
    print(json.dumps({"iterations": res.iterations, "converged": res.converged, "k": len(res.centroids),
                      "points": res.points, "skipped": res.skipped, "skipped_seeds": seeds.skipped}))


def _write_rounds(hist, out: str, layout: str, iterations: int) -> None:
    """Centroids of every round: one table partitioned by ``iteration``
    (default), or one ``iteration_<i>`` folder per round as the original jobs
    write them (``layout='reference'``; k lines each)."""
    if layout == "reference":
        for i in range(1, iterations + 1):
            D.write_delimited(hist.where(F.col("iteration") == i).drop("iteration").coalesce(1),
                              f"{out}/iteration_{i}")
    else:
        D.write_history(hist, f"{out}/rounds")


def run_silhouette(spark, args) -> None:
    a = D.read_assignments2d(spark, args.assignments)
    # a centroid without both numbers names no cluster
    a = a.withColumn("cluster", F.when(F.col("cx").isNotNull() & F.col("cy").isNotNull(), F.concat_ws(",", "cx", "cy")))
    valid = F.col("cluster").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    seen = Observation("assignments")
    counted = a.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid"))
    coords = SIL.silhouette_coordinates(counted, "cluster", "x", "y", args.mode).checkpoint(eager=True)
    per = SIL.points_from(coords, a.where(valid), "cluster", "x", "y")
    D.write_delimited(per.select("x", "y", "silhouette"), f"{args.out}/points")
    m = SIL.mean_from(coords)
    label = F.concat(F.lit("Silhouette Coefficient for k = "), F.col("clusters").cast("string"))
    D.write_delimited(m.select(label, format4(F.col("mean_silhouette"))), f"{args.out}/mean")
    print(json.dumps({"points": int(seen.get["valid"]), "skipped": int(seen.get["rows"] - seen.get["valid"])}))


def run_trips(spark, args) -> None:
    trips = D.read_trips(spark, args.input)
    D.write_delimited(T.trip_features(trips), f"{args.out}/features")
    print(json.dumps({"mean_card_tip": T.mean_card_tip(trips).first()[0]}))


def run_generate(spark, args) -> None:
    G.write_points(G.points_range(spark, args.n, args.seed), f"{args.out}/data_points")
    G.write_seeds(G.points_range(spark, args.k, args.seed + 1), f"{args.out}/{args.k}seed_points")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: the active or submitted session")
    p.add_argument("--shuffle-partitions", type=int, default=None, help="default: what the session has")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("report")
    r.add_argument("name", help="A..H or a report name")
    for k in ("people", "logs", "associates"):
        r.add_argument(f"--{k}")
    r.add_argument("--out", required=True)
    r.add_argument("--quarantine", help="folder for the input lines that do not fit, by input, with the reason")
    r.add_argument("--unchecked", action="store_true", help="do not read the inputs once more to count bad lines")
    r.add_argument("--nationality", default=NATIONALITY)
    r.add_argument("--k", type=int, default=TOP_PAGES)
    r.add_argument("--threshold", type=int, default=LATEST_ACCESS_MIN)
    r.add_argument("--order", choices=["text", "numeric"], default="text")
    r.add_argument("--keep", choices=["ge", "lt"], default="ge")

    for cmd, thr, it in (("kmeans", THRESHOLD_2D, CONV_R), ("kmeans-nd", THRESHOLD_ND, ROUNDS_ND)):
        k = sub.add_parser(cmd)
        k.add_argument("--points", required=True)
        k.add_argument("--seeds", required=True)
        k.add_argument("--out", required=True)
        k.add_argument("--max-iter", type=int, default=it)
        k.add_argument("--threshold", type=float, default=thr)
        k.add_argument("--fixed", action="store_true", help="run all rounds, test the last two only")
        k.add_argument("--assignments", action="store_true")
        k.add_argument("--layout", choices=["table", "reference"], default="table",
                       help="rounds as one partitioned table, or one iteration_<i> folder per round")
        if cmd == "kmeans":
            k.add_argument("--grouped", action="store_true", help="lay the cluster table out by cluster")
        if cmd == "kmeans-nd":
            k.add_argument("--criterion", choices=["any", "all"], default="any")

    s = sub.add_parser("silhouette")
    s.add_argument("--assignments", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--mode", choices=["reference", "textbook"], default="reference")

    t = sub.add_parser("trips")
    t.add_argument("--input", required=True)
    t.add_argument("--out", required=True)

    g = sub.add_parser("generate")
    g.add_argument("--n", type=int, default=GENERATED_POINTS)
    g.add_argument("--k", type=int, required=True)
    g.add_argument("--seed", type=int, default=7)
    g.add_argument("--out", required=True)

    args = p.parse_args(argv)
    spark = _session(args)
    {"report": run_report, "kmeans": run_kmeans, "kmeans-nd": run_kmeans_nd, "silhouette": run_silhouette,
     "trips": run_trips, "generate": run_generate}[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
