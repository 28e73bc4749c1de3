"""k-means with given seeds, truncating integer means and explicit rules.

One round = one Spark job: every task finds the nearest centroid of its points
in Arrow batches with numpy and returns at most k partial sums, so a cluster
holding a third of all points costs no more than any other.  The centroids go
out by broadcast, not as plan text, so there may be thousands of them and the
plan does not change from round to round.  2-D rounds read a persisted table
of distinct coordinates with their point counts (exactly equivalent, and
bounded by the integer grid) in Morton order, in which bounds on boxes of
neighbouring points leave out most distances
(:mod:`tessera.functions.geometry`).  The bounds need no state of their own:
nothing is written between rounds.  Several 2-D runs share each round's job.
Only the k new centroids of a run come back to the driver.

Semantics kept from the reference jobs:

* ties go to the first centroid in list order; round 1 uses seed order, later
  rounds the byte order of the *previous* centroid's text (``"x,y"`` in 2-D,
  the id in N-D, so "10" sorts before "2");
* a centroid with no points disappears (k can shrink, no re-seeding);
* 2-D means truncate toward zero (sums are 64-bit, so no overflow);
* 2-D convergence: every new centroid lies within ``threshold`` of some
  previous centroid; N-D convergence matches centroids by id, and is
  ``any`` (one id moved at most ``threshold``, the reference) or ``all``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.fixed import ROUNDS_ND, THRESHOLD_2D, THRESHOLD_ND
from tessera.functions.geometry import MAX_COORDINATE, Boxes, morton, nearest, nearest_in
from tessera.session import cores

Centroid2D = tuple[int, int]
CentroidND = tuple[int, list[float]]


def spread(df: DataFrame) -> DataFrame:
    """Deal the loop input over ``defaultParallelism`` partitions before it is
    persisted (the input is an aggregate that AQE may coalesce to one, or a
    table whose files may be fewer than the cores)."""
    return df.repartition(cores(df.sparkSession))


def _trunc_div(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b >= 0) else -q


# ---------------------------------------------------------------- 2-D family

def _places(centroids: Sequence[Centroid2D]) -> tuple[np.ndarray, np.ndarray]:
    c = np.array(centroids, np.int64).reshape(-1, 2)
    if len(c) and np.abs(c).max() >= MAX_COORDINATE:
        raise OverflowError(f"a centroid beyond {MAX_COORDINATE}")
    return c[:, 0].copy(), c[:, 1].copy()


def _whole(column) -> np.ndarray:
    import pyarrow as pa

    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)


def assign2d(points: DataFrame, centroids: Sequence[Centroid2D], x: str = "x", y: str = "y") -> DataFrame:
    """Points with ``pos``, ``cx``, ``cy`` of their nearest centroid.  Points
    without both coordinates are skipped, as the fit skips them."""
    sent = points.sparkSession.sparkContext.broadcast(_places(centroids))
    schema = T.StructType(points.schema.fields + T.StructType.fromDDL("pos int, cx bigint, cy bigint").fields)
    ix, iy = points.columns.index(x), points.columns.index(y)

    def run(batches):
        import pyarrow as pa

        cx, cy = sent.value
        for b in batches:
            pos = nearest(_whole(b.column(ix)), _whole(b.column(iy)), cx, cy)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pos, pa.int32()), pa.array(cx[pos]), pa.array(cy[pos])], names=schema.names)

    return points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).mapInArrow(run, schema)


def weighted_coordinates(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Distinct (x, y) with the number of points ``w``.  The nearest centroid
    depends on the coordinates only, so rounds over this table give exactly
    the results of rounds over the points, and on the bounded integer grid the
    table stops growing with the data."""
    return (points.select(F.col(x).cast("bigint").alias("x"), F.col(y).cast("bigint").alias("y"))
            .where(F.col("x").isNotNull() & F.col("y").isNotNull())
            .groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")))


def _partial_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, runs) -> list[tuple]:
    """(run, pos, sx, sy, n, distances) of some points in boxes of neighbours:
    boxes with one candidate are added whole.  Sums are exact integers."""
    boxes, out = Boxes(x, y), []
    if not len(x):
        return out
    far = max(int(np.abs(x).max()), int(np.abs(y).max()), 1)
    if float(np.abs(w).sum(dtype=np.float64)) * far >= 2.0 ** 62:
        raise OverflowError("sums of coordinates beyond 64 bits")
    point = np.column_stack([w * x, w * y, w])
    whole = np.add.reduceat(point, boxes.start)
    for run, (cx, cy) in runs.items():
        only, pos, computed = nearest_in(boxes, cx, cy)
        sums = np.zeros((len(cx), 3), np.int64)
        won = only >= 0
        np.add.at(sums, only[won], whole[won])
        rest = np.repeat(~won, boxes.size)
        np.add.at(sums, pos[rest], point[rest])
        for i in np.flatnonzero(sums[:, 2]):
            out.append((run, int(i), *sums[i].tolist(), computed))
            computed = 0
    return out


#: partial sums that a round may bring to the driver without adding them up
#: in the cluster first
MAX_PARTIALS = 50_000


def step_runs(points: DataFrame, runs: dict[int, Sequence[Centroid2D]], x: str = "x", y: str = "y",
              weight: str | None = None, tasks: int | None = None
              ) -> dict[int, tuple[list[Centroid2D], list[int], int]]:
    """One round of several runs over the same points, as one job: for each
    run its new centroids in next-round order, their sizes, and the distances
    computed.  ``weight`` names a column of point counts (see
    :func:`weighted_coordinates`).  With ``tasks``, the number of partitions,
    it is known how many partial sums there can be; up to ``MAX_PARTIALS`` they
    are added up on the driver, which saves the round a shuffle."""
    sent = points.sparkSession.sparkContext.broadcast({r: _places(c) for r, c in runs.items()})

    def run(batches):
        import pyarrow as pa

        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            w = _whole(b.column(2)) if weight else np.ones(b.num_rows, np.int64)
            for r, i, *sums in _partial_sums(_whole(b.column(0)), _whole(b.column(1)), w, sent.value):
                held = total.get((r, i))
                total[r, i] = np.array(sums, object) if held is None else held + sums
        rows = [(*k, *v) for k, v in total.items()]
        names = ["run", "pos", "sx", "sy", "n", "computed"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(row[j]) for row in rows], pa.int32() if j < 2 else pa.int64()) for j in range(6)], names=names)

    part = (points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y, *([weight] if weight else []))
            .mapInArrow(run, "run int, pos int, sx long, sy long, n long, computed long"))
    if tasks is None or tasks * sum(map(len, runs.values())) > MAX_PARTIALS:
        part = part.groupBy("run", "pos").agg(*[F.sum(c).alias(c) for c in ("sx", "sy", "n", "computed")])
    sums: dict[int, dict[int, list[int]]] = {r: {} for r in runs}
    for r, i, *v in part.collect():
        held = sums[r].get(i)
        sums[r][i] = v if held is None else [p + q for p, q in zip(held, v)]
    sent.unpersist()
    out = {}
    for r, centroids in runs.items():
        rows = sorted((f"{centroids[i][0]},{centroids[i][1]}".encode(), (_trunc_div(sx, n), _trunc_div(sy, n)), n)
                      for i, (sx, sy, n, _) in sums[r].items())
        out[r] = [t[1] for t in rows], [t[2] for t in rows], sum(v[3] for v in sums[r].values())
    return out


def step2d(points: DataFrame, centroids: Sequence[Centroid2D], x: str = "x", y: str = "y",
           weight: str | None = None) -> tuple[list[Centroid2D], list[int]]:
    """One round: new centroids in next-round order, and their sizes."""
    return step_runs(points, {0: centroids}, x, y, weight)[0][:2]


def converged2d(previous: Sequence[Centroid2D], current: Sequence[Centroid2D], threshold: float) -> bool:
    """Every current centroid has a previous one within ``threshold``."""
    for cx, cy in current:
        nearest = min(math.sqrt((cx - px) ** 2 + (cy - py) ** 2) for px, py in previous)
        if nearest > threshold:
            return False
    return True


@dataclass
class KMeansResult:
    centroids: list            # final centroids in list order
    sizes: list[int]           # points per final centroid
    iterations: int
    converged: bool
    history: list = field(default_factory=list)   # (iteration, centroids)
    points: int | None = None  # input rows seen when the loop input was built
    skipped: int | None = None # of which left out (null coordinates, other dimension)
    computed: list[int] = field(default_factory=list)   # 2-D: distances computed in each round


def _observed_input(df: DataFrame, valid) -> tuple[DataFrame, Observation]:
    """Count all rows and the valid ones while the loop input is materialised
    (metrics ride on that same pass; no extra scan)."""
    obs = Observation("loop_input")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.sum(F.when(valid, 1).otherwise(0)).alias("valid")), obs


def prepare2d(points: DataFrame, x: str = "x", y: str = "y", observation: list | None = None) -> DataFrame:
    """The persisted loop input: weighted distinct coordinates in Morton order
    over as many partitions as there are cores.  The caller unpersists it.
    Pass a list as ``observation`` to receive the :class:`Observation` with
    the input row counts."""
    src, obs = _observed_input(points, F.col(x).isNotNull() & F.col(y).isNotNull())
    if observation is not None:
        observation.append(obs)
    place = weighted_coordinates(src, x, y).withColumn("place", morton(F.col("x"), F.col("y")))
    return (place.repartitionByRange(cores(points.sparkSession), "place").sortWithinPartitions("place")
            .drop("place").persist(StorageLevel.MEMORY_AND_DISK))


def fit_runs2d(pts: DataFrame, seeds: dict[int, Sequence[Centroid2D]], max_iter: int, threshold: float = THRESHOLD_2D,
               early_stop: bool = True) -> dict[int, KMeansResult]:
    """Several runs over a table from :func:`prepare2d` (see :func:`fit2d`).
    All runs that have not stopped share a round's job, so there are as many
    jobs as the longest run has rounds."""
    if not all(seeds.values()):
        raise ValueError("no seeds")
    tasks = cores(pts.sparkSession)
    out = {r: KMeansResult(list(s), [], 0, False) for r, s in seeds.items()}
    running = dict(seeds)
    for it in range(1, max_iter + 1):
        for r, (cur, sizes, computed) in step_runs(pts, {r: out[r].centroids for r in running}, weight="w", tasks=tasks).items():
            res, prev = out[r], out[r].centroids
            res.centroids, res.sizes, res.iterations = cur, sizes, it
            res.history.append((it, cur))
            res.computed.append(computed)
            if early_stop and it >= 2 or not early_stop and it == max_iter:
                res.converged = converged2d(prev, cur, threshold)
            if early_stop and res.converged:
                del running[r]
        if not running:
            break
    return out


def fit2d(points: DataFrame, seeds: Sequence[Centroid2D], max_iter: int, threshold: float = THRESHOLD_2D,
          early_stop: bool = True, x: str = "x", y: str = "y") -> KMeansResult:
    """Rounds of :func:`step_runs`.

    ``early_stop=True``: from round 2 on, stop as soon as the round converged
    (jobs C3, C4, C6).  ``early_stop=False``: run all ``max_iter`` rounds and
    test only the last two (C2); with ``max_iter=1`` that compares the seeds
    with the first result (C1).
    """
    seen: list = []
    pts = prepare2d(points, x, y, seen)
    try:
        res = fit_runs2d(pts, {0: seeds}, max_iter, threshold, early_stop)[0]
        m = seen[0].get
        res.points, res.skipped = int(m["rows"]), int(m["rows"] - (m["valid"] or 0))
        return res
    finally:
        pts.unpersist()


def centroids_frame2d(spark: SparkSession, res: KMeansResult) -> DataFrame:
    """(pos, x, y, size, iterations, converged): a k-row result table."""
    schema = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("x", T.IntegerType()),
                           T.StructField("y", T.IntegerType()), T.StructField("size", T.LongType()),
                           T.StructField("iterations", T.IntegerType()),
                           T.StructField("converged", T.BooleanType())])
    rows = [(i, int(cx), int(cy), int(n), res.iterations, res.converged)
            for i, ((cx, cy), n) in enumerate(zip(res.centroids, res.sizes))]
    return spark.createDataFrame(rows, schema)


def history_frame2d(spark: SparkSession, res: KMeansResult) -> DataFrame:
    """(iteration, pos, x, y) for every round."""
    schema = T.StructType([T.StructField("iteration", T.IntegerType()), T.StructField("pos", T.IntegerType()),
                           T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])
    rows = [(it, i, int(cx), int(cy)) for it, cents in res.history for i, (cx, cy) in enumerate(cents)]
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- N-D family

# doubles of a distance block in the N-D kernel (a slice of rows by k)
KERNEL_DOUBLES = 1 << 20


def is_valid_nd(dim: int, coords: str = "coords"):
    """Whether a vector has the declared dimension and no null element."""
    return F.coalesce((F.size(coords) == dim) & ~F.exists(coords, lambda v: v.isNull()), F.lit(False))


def valid_nd(points: DataFrame, dim: int, coords: str = "coords") -> DataFrame:
    """Points of the declared dimension without null elements (others are
    skipped, as the reference skips vectors of another length)."""
    return points.where(is_valid_nd(dim, coords))


def _nearest_kernel(centroids: Sequence[CentroidND]):
    """rows (n, dim) -> position of the nearest centroid of each.  Squared
    differences are added dimension by dimension, then the root is taken; the
    first centroid wins ties."""
    cents = np.array([v for _, v in centroids], np.float64)
    step = max(1, KERNEL_DOUBLES // len(cents))

    def nearest(rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        for i in range(0, len(rows), step):
            part = rows[i:i + step]
            d2 = np.zeros((len(part), len(cents)))
            for j in range(cents.shape[1]):
                diff = part[:, j, None] - cents[None, :, j]
                d2 += diff * diff
            out[i:i + step] = np.sqrt(d2).argmin(axis=1)
        return out

    return nearest


def _vectors(batch, coords: str, dim: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(coords)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def assign_nd(points: DataFrame, centroids: Sequence[CentroidND], coords: str = "coords") -> DataFrame:
    """Points with ``pos`` and ``cid`` of their nearest centroid; vectors of
    another dimension or with null elements are skipped."""
    dim = len(centroids[0][1])
    sent = points.sparkSession.sparkContext.broadcast(list(centroids))
    schema = T.StructType(points.schema.fields + [T.StructField("pos", T.IntegerType()), T.StructField("cid", T.IntegerType())])

    def run(batches):
        import pyarrow as pa

        nearest = _nearest_kernel(sent.value)
        ids = np.array([cid for cid, _ in sent.value])
        for batch in batches:
            pos = nearest(_vectors(batch, coords, dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pos, pa.int32()), pa.array(ids[pos], pa.int32())], names=schema.names)

    return valid_nd(points, dim, coords).mapInArrow(run, schema)


#: partial vector sums that one task adds up; more are added in two steps
MERGE_ROWS = 1024


def vector_sums(parts: DataFrame, tasks: int) -> DataFrame:
    """(pos, n, sums): the array sums of partial sums (pos, n, sums) of
    ``tasks`` tasks, one row for each pos.  Each pos has at most one row a task;
    beyond ``MERGE_ROWS`` tasks they meet in groups of that size first, so no
    task adds up more."""
    schema = "pos int, n long, sums array<double>"

    def add(table):
        import pyarrow as pa

        sums = table.column("sums").combine_chunks()
        total = sums.flatten().to_numpy(zero_copy_only=False).reshape(len(table), -1).sum(axis=0)
        return pa.table({"pos": table.column("pos").slice(0, 1),
                         "n": pa.array([int(table.column("n").to_numpy().sum())]), "sums": pa.array([total.tolist()])})

    if tasks > MERGE_ROWS:
        some = parts.withColumn("some", F.spark_partition_id() % -(-tasks // MERGE_ROWS))
        parts = some.groupBy("pos", "some").applyInArrow(add, schema)
    return parts.groupBy("pos").applyInArrow(add, schema)


def step_nd(points: DataFrame, centroids: Sequence[CentroidND], dim: int, coords: str = "coords",
            tasks: int | None = None) -> tuple[list[CentroidND], list[int]]:
    """One N-D round over valid points: the mean vector per centroid id.  A
    task assigns its points batch by batch and returns at most k partial sums;
    they are added up as arrays, and k rows come to the driver.  Centroids are
    sent by broadcast, not as plan text.  Next-round order = id as text.
    ``tasks`` is the number of partitions, if known."""
    sent = points.sparkSession.sparkContext.broadcast(list(centroids))

    def run(batches):
        import pyarrow as pa

        k = len(sent.value)
        nearest, count, sums = _nearest_kernel(sent.value), np.zeros(k, np.int64), np.zeros((k, dim))
        for batch in batches:
            rows = _vectors(batch, coords, dim)
            pos = nearest(rows)
            count += np.bincount(pos, minlength=k)
            for j in range(dim):
                sums[:, j] += np.bincount(pos, rows[:, j], k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(count[held]), pa.array(sums[held].tolist(), pa.list_(pa.float64()))],
            names=["pos", "n", "sums"])

    part = points.select(coords).mapInArrow(run, "pos int, n long, sums array<double>")
    if tasks is None:
        tasks = points.rdd.getNumPartitions()
    rows = vector_sums(part, tasks).collect()
    sent.unpersist()
    out = sorted(((str(centroids[r["pos"]][0]).encode(), (int(centroids[r["pos"]][0]), [v / r["n"] for v in r["sums"]]),
                   int(r["n"])) for r in rows), key=lambda t: t[0])
    return [t[1] for t in out], [t[2] for t in out]


def converged_nd(previous: Sequence[CentroidND], current: Sequence[CentroidND], threshold: float,
                 criterion: str = "any") -> bool:
    prev = {cid: v for cid, v in previous}
    moved = [math.sqrt(sum((a - b) ** 2 for a, b in zip(v, prev[cid]))) <= threshold
             for cid, v in current if cid in prev]
    if criterion == "any":
        return any(moved)
    if criterion == "all":
        return bool(moved) and all(moved) and len(moved) == len(current)
    raise ValueError("criterion must be 'any' or 'all'")


def fit_nd(points: DataFrame, seeds: Sequence[CentroidND], max_iter: int = ROUNDS_ND, threshold: float = THRESHOLD_ND,
           criterion: str = "any", early_stop: bool = True, coords: str = "coords") -> KMeansResult:
    """N-D rounds.  From round 2 the new centroids are compared with the
    previous ones by id; once converged the flag stays set, and with
    ``early_stop`` the loop ends there."""
    dim = len(seeds[0][1])
    src, obs = _observed_input(points.select(F.col(coords).alias("coords")), is_valid_nd(dim))
    pts = spread(valid_nd(src, dim)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pts.count()                      # materialise once; fills the observation
        n_rows = int(obs.get["rows"])
        n_skipped = n_rows - int(obs.get["valid"] or 0)
        prev = [(int(i), [float(v) for v in c]) for i, c in seeds]
        history, sizes, converged, it = [], [], False, 0
        for it in range(1, max_iter + 1):
            cur, sizes = step_nd(pts, prev, dim, tasks=cores(pts.sparkSession))
            history.append((it, cur))
            if it >= 2 and not converged and converged_nd(prev, cur, threshold, criterion):
                converged = True
                if early_stop:
                    prev = cur
                    break
            prev = cur
        return KMeansResult(prev, sizes, it, converged, history, n_rows, n_skipped)
    finally:
        pts.unpersist()


def centroids_frame_nd(spark: SparkSession, res: KMeansResult, digits: int = 6) -> DataFrame:
    """(cid, size, dim, value, iterations, converged): a row for every
    coordinate of every centroid, dimensions from 1, rounded."""
    rows = [(cid, int(n), j, float(x), res.iterations, res.converged)
            for (cid, v), n in zip(res.centroids, res.sizes) for j, x in enumerate(v, 1)]
    df = spark.createDataFrame(rows, "cid int, size long, dim int, value double, iterations int, converged boolean")
    return df.withColumn("value", F.round("value", digits))


def history_frame_nd(spark: SparkSession, res: KMeansResult, digits: int = 6) -> DataFrame:
    """(iteration, cid, dim, value) for every round."""
    rows = [(it, cid, j, float(x)) for it, cents in res.history for cid, v in cents for j, x in enumerate(v, 1)]
    return spark.createDataFrame(rows, "iteration int, cid int, dim int, value double").withColumn(
        "value", F.round("value", digits))


def wide_frame_nd(spark: SparkSession, rows: list[tuple], lead: list[str]) -> DataFrame:
    """Rows of (*lead, *coordinates) as columns ``lead``, c1 .. cd."""
    dim = len(rows[0]) - len(lead)
    return spark.createDataFrame(rows, lead + [f"c{i}" for i in range(1, dim + 1)])
