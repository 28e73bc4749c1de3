"""Exact silhouette of a 2-D clustering, without per-pair rows.

The silhouette of a point depends only on its coordinates and cluster, so
points are first reduced to distinct ``(cluster, x, y)`` with a weight ``w``
(a coordinate holding a third of all points becomes one row).  The mean
distance from a coordinate to a cluster is ``S(q, c) / |c|`` with
``S(q, c) = sum of w_r * |q - r|`` over the cluster's coordinates ``r``.

Of all clusters but the own one only the least mean matters, and two bounds
leave most of them out.  With ``d`` the distance from q to the cluster's true
mean and ``V`` the mean squared distance of its points from that mean,

    d  <=  S(q, c) / |c|  <=  sqrt(d^2 + V)

(Jensen's inequality, for the norm and for the root).  A cluster whose lower
bound exceeds the least upper bound of the others cannot have the least mean,
so q never meets it.  The bounds need one exact sum per cluster and no pass of
their own; the clusters that are left are computed exactly.

``S`` is computed on a grid of cells.  Each cluster's coordinates are hashed
into groups of about ``block_rows`` rows (by default chosen from the number of
distinct coordinates, the task slots and the memory of a group).  The hash is
of columns, runs of 16384 grid places with one x, so no group can grow with a
hot key.  Clusters are numbered in a table that is joined, so there may be any
number of them.  A cell pairs the coordinates of group ``i`` that need a
cluster with group ``j`` of that cluster: every query row is copied to the
groups of the clusters it needs, every reference row to the groups of the
clusters with a query that needs its own, the two sides are co-grouped by
cell, and a numpy kernel (``cogroup().applyInPandas``) turns a cell into one
partial sum per query coordinate: by convolution of columns where they are
filled densely, pair by pair elsewhere (:func:`distance_sums`).  Cells that no query needs do not exist.
Spark then adds the partial sums per (coordinate, cluster) with partial
aggregation.  Memory per cell is bounded and no pair is ever a row.  The sums
are exact but for rounding; pair by pair the work is quadratic in the
coordinates of neighbouring clusters, by columns in their columns.

Several clusterings (a column ``run`` tells them apart) are scored in one such
job: the grid of each is its own, and only the scheduling is shared.

Modes (``mode``):

* ``"reference"`` (default): a(i) leaves out every point at the same
  coordinates, from sum and count; a point with no other coordinates in its
  cluster gets a = 0, hence s = 1; b(i) is the least mean distance to
  another cluster.
* ``"textbook"``: a(i) averages over all other points of the cluster
  (coincident ones count with distance 0); a point alone in its cluster
  gets s = 0.

With one cluster only, b is undefined and s is null, as it is where a and b
are both 0.  Rows without a cluster or a coordinate are skipped: they count
nowhere and have a null silhouette.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import checked_broadcast
from tessera.session import cores, ensure_checkpoint_dir

ROW_BYTES = 48                    # a coordinate row in a shuffle or a group
GROUP_BYTES = 64 << 20            # memory of one group of a cell
TASK_BYTES = 128 << 20            # moved rows of one task
MIN_BLOCK_ROWS = 4096             # below this a cell costs more to start than to compute
MAX_BROADCAST_CLUSTERS = 100_000  # a larger table of clusters is joined by shuffling
KERNEL_DOUBLES = 1 << 21          # ~16 MB per temporary distance matrix
COLUMN_BITS = 14                  # a column: this many bits of y at one x
COLUMN_DOUBLES = 1 << 23          # ~64 MB of columns transformed at a time, of each side
MIN_COLUMN_PAIRS = 1 << 20        # fewer pairs are computed one by one
HEAVY = 16                        # times the mean weight: taken pair by pair
PARTIAL_SCHEMA = "cid int, x bigint, y bigint, w bigint, rcid int, s double"


def _direct_sums(qx, qy, rx, ry, rw):
    """For every query the weighted sum of distances to the references.  The
    distance matrix is built a slice of query rows at a time, ``KERNEL_DOUBLES``
    entries per slice."""
    import numpy as np

    sums = np.zeros(len(qx))
    if not len(rx):
        return sums
    qx, qy, rx, ry, rw = (c.astype(np.float64) for c in (qx, qy, rx, ry, rw))
    step = max(1, KERNEL_DOUBLES // len(rx))
    for i in range(0, len(qx), step):
        dx = qx[i:i + step, None] - rx[None, :]
        dy = qy[i:i + step, None] - ry[None, :]
        sums[i:i + step] = np.sqrt(dx * dx + dy * dy) @ rw
    return sums


def _columns(x, y, x0: int, y0: int, blocks: int):
    """(x, block of y, column of each row, its place in the column)."""
    import numpy as np

    key, col = np.unique((x - x0) * blocks + ((y - y0) >> COLUMN_BITS), return_inverse=True)
    return key // blocks, key % blocks, col, (y - y0) & ((1 << COLUMN_BITS) - 1)


def distance_sums(qx, qy, rx, ry, rw):
    """For every query coordinate, the weighted sum of distances to the
    reference coordinates (integer arrays; references are distinct).

    Between two columns, runs of ``2 ** COLUMN_BITS`` grid places with one x,
    a distance depends on the difference of the places only, so the sums of
    all queries of one column are a convolution.  Where columns are filled
    densely enough it is taken by Fourier transforms, whose cost depends on the
    columns and not on the pairs of their rows; else pair by pair.  References
    of outstanding weight are always taken pair by pair: the rounding of a
    transform is relative to its largest terms.
    """
    import numpy as np

    n, m = len(qx), len(rx)
    if not n or not m:
        return np.zeros(n)
    x0, y0 = min(int(qx.min()), int(rx.min())), min(int(qy.min()), int(ry.min()))
    x1, y1 = max(int(qx.max()), int(rx.max())), max(int(qy.max()), int(ry.max()))
    blocks = ((y1 - y0) >> COLUMN_BITS) + 1
    if n * m < MIN_COLUMN_PAIRS or max(x1 - x0, y1 - y0) >= 1 << 31:
        return _direct_sums(qx, qy, rx, ry, rw)
    heavy = rw > HEAVY * rw.mean()
    ax, ab, acol, aplace = _columns(qx, qy, x0, y0, blocks)
    bx, bb, bcol, bplace = _columns(rx[~heavy], ry[~heavy], x0, y0, blocks)
    a0, b0 = int(aplace.min()), int(bplace.min())
    aplace, bplace = aplace - a0, bplace - b0
    size = 1 << int(aplace.max() + bplace.max() + 1).bit_length()
    pairs, each = len(ax) * len(bx), max(1, COLUMN_DOUBLES // size)
    if pairs * size >= n * m:
        return _direct_sums(qx, qy, rx, ry, rw)
    dx = np.abs(ax[:, None] - bx[None, :])
    db = ab[:, None] - bb[None, :] + blocks
    kinds, kind = np.unique(dx * (2 * blocks) + db, return_inverse=True)
    kind = kind.reshape(len(ax), len(bx))
    chunks = -(-len(ax) // each) * -(-len(bx) // each)
    transforms = len(ax) + len(bx) * -(-len(ax) // each) + min(pairs, len(kinds) * chunks)
    if (pairs + transforms * size.bit_length()) * size + n * int(heavy.sum()) >= n * m:
        return _direct_sums(qx, qy, rx, ry, rw)

    sums = _direct_sums(qx, qy, rx[heavy], ry[heavy], rw[heavy])
    weight = rw[~heavy].astype(np.float64)
    step = np.arange(size)
    step = np.where(step > aplace.max(), step - size, step) + (a0 - b0)   # place of the query less the reference's
    for i in range(0, len(ax), each):
        found = np.zeros((min(each, len(ax) - i), size // 2 + 1), np.complex128)
        for j in range(0, len(bx), each):
            part = np.zeros((min(each, len(bx) - j), size))
            at = (bcol >= j) & (bcol < j + each)
            part[bcol[at] - j, bplace[at]] = weight[at]
            part = np.fft.rfft(part, axis=1)
            here = kind[i:i + each, j:j + each]
            for k in np.unique(here):
                kx, kb = float(kinds[k] // (2 * blocks)), int(kinds[k] % (2 * blocks)) - blocks
                dy = (step + (kb << COLUMN_BITS)).astype(np.float64)
                wave = np.fft.rfft(np.sqrt(kx * kx + dy * dy))
                for a, b in zip(*np.nonzero(here == k)):
                    found[a] += wave * part[b]
        at = (acol >= i) & (acol < i + each)
        sums[at] += np.fft.irfft(found, size, axis=1)[acol[at] - i, aplace[at]]
    return sums


def _cell_kernel():
    """One cell: for every query coordinate, the weighted sum of distances to
    the cell's reference coordinates (all of one cluster)."""
    import numpy as np
    import pandas as pd

    def kernel(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if len(q) and len(r):
            sums = distance_sums(*(q[c].to_numpy() for c in ("x", "y")), *(r[c].to_numpy() for c in ("x", "y", "w")))
            out = q[["cid", "x", "y", "w"]]
            rcid = int(r["cid"].iloc[0])
        else:
            out, sums, rcid = q.iloc[:0][["cid", "x", "y", "w"]], np.empty(0), 0
        return out.assign(rcid=np.full(len(out), rcid, np.int32), s=sums)

    return kernel


def coordinate_weights(assign: DataFrame, cluster: str = "pos", x: str = "x", y: str = "y",
                       weight: str | None = None, run: str | None = None) -> DataFrame:
    """Distinct (cluster, x, y) with the number of points ``w`` (or the sum of
    the column ``weight``), over the rows that have all three; with ``run``,
    within each clustering of that column."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    keys = {**({"run": run} if run else {}), "cluster": cluster, "x": x, "y": y}
    return (assign.where(F.col(cluster).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(*[F.col(c).alias(name) for name, c in keys.items()]).agg(w.alias("w")))


SLACK = 1e-9   # relative: bounds are rounded, a cluster that could tie is kept


def _bounds_kernel(table, each: bool):
    """Adds ``rcid`` to coordinates (.., cid, x, y at the places given by
    ``each``), one row for each cluster they need: their own, and the others
    whose lower bound does not exceed the least upper bound.  ``table`` is the
    broadcast {run: (cid, mean x, mean y, mean squared distance)}."""
    import numpy as np

    doubles = KERNEL_DOUBLES

    def run(batches):
        import pyarrow as pa

        clusters = table.value
        for b in batches:
            runs = b.column(0).to_pylist() if each else [None] * b.num_rows
            first = 1 if each else 0
            cid, x, y = (b.column(first + j).to_numpy(zero_copy_only=False) for j in range(3))
            at, needed = [], []
            places = {}
            for i, r in enumerate(runs):
                places.setdefault(r, []).append(i)
            for r, rows in places.items():
                ids, mx, my, v = clusters[r]
                step = max(1, doubles // len(ids))
                for lo in range(0, len(rows), step):
                    part = np.array(rows[lo:lo + step])
                    d2 = (x[part, None] - mx) ** 2 + (y[part, None] - my) ** 2
                    own = ids == cid[part, None]
                    least = np.where(own, np.inf, d2 + v).min(axis=1)
                    row, c = np.nonzero(own | (d2 * (1 - SLACK) <= least[:, None] * (1 + SLACK)))
                    at.append(part[row])
                    needed.append(ids[c])
            if at:
                table_ = pa.Table.from_batches([b]).take(pa.array(np.concatenate(at)))
                table_ = table_.append_column("rcid", pa.array(np.concatenate(needed), pa.int32()))
                yield from table_.to_batches()

    return run


def needed_clusters(coords: DataFrame, stats: DataFrame, run: str | None = None) -> DataFrame:
    """Rows (.., rcid) of ``coords`` (run, cid, x, y, ..) for every cluster
    they need, from ``stats`` (run, cid, n, sx, sy, sq) with the exact sums of
    weight, coordinates and squares.  Above ``MAX_BROADCAST_CLUSTERS`` clusters
    no bounds are taken: every cluster is needed."""
    import numpy as np

    each = ["run"] if run else []
    rows = stats.select(*each, "cid", "n", "sx", "sy", "sq").limit(MAX_BROADCAST_CLUSTERS + 1).collect()
    if len(rows) > MAX_BROADCAST_CLUSTERS:
        # ids are consecutive within a clustering
        span = stats.groupBy(*each).agg(F.min("cid").alias("lo"), F.max("cid").alias("hi"))
        if each:
            spanned = coords.join(span, each)
        else:
            lo, hi = span.first()
            spanned = coords.select("*", F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        return spanned.select(*coords.columns, F.explode(F.sequence("lo", "hi")).alias("rcid"))
    table: dict = {}
    for r in rows:
        n, sx, sy, sq = (int(r[c]) for c in ("n", "sx", "sy", "sq"))
        table.setdefault(r["run"] if run else None, []).append(
            (r["cid"], sx / n, sy / n, (n * sq - sx * sx - sy * sy) / (n * n)))
    sent = coords.sparkSession.sparkContext.broadcast(
        {k: (np.array([c[0] for c in v], np.int32), *(np.array([c[j] for c in v]) for j in (1, 2, 3)))
         for k, v in table.items()})
    schema = T.StructType([*coords.schema.fields, T.StructField("rcid", T.IntegerType())])
    return coords.mapInArrow(_bounds_kernel(sent, bool(run)), schema)


def _numbered(W: DataFrame, each: list[str], block_rows: int | None, slots: int) -> DataFrame:
    """Clusters with dense id, points, exact sums, and their groups: how many
    and the number of the first."""
    w, x, y = (F.col(c).cast("decimal(38,0)") for c in ("w", "x", "y"))
    per_cluster = W.groupBy(*each, "cluster").agg(
        F.sum("w").alias("n"), F.count(F.lit(1)).alias("d"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
        F.sum(w * (x * x + y * y)).alias("sq"))
    if block_rows is None:
        # moved data falls as groups grow, parallelism needs about 4 cells for
        # each task slot, and a group fits GROUP_BYTES
        share = F.ceil(F.sum("d").over(Window.partitionBy()) / F.lit(math.sqrt(4 * max(1, slots))))
        rows = F.greatest(F.lit(MIN_BLOCK_ROWS), F.least(F.lit(GROUP_BYTES // ROW_BYTES), share))
    else:
        rows = F.lit(block_rows)
    order = Window.orderBy(*each, "cluster")
    return (per_cluster.select("*", F.ceil(F.col("d") / rows).alias("nb"))
            .select("*", (F.row_number().over(order) - 1).alias("cid"),
                    (F.sum("nb").over(order) - F.col("nb")).alias("first")).checkpoint(eager=True))


def silhouette_coordinates(assign: DataFrame, cluster: str = "pos", x: str = "x", y: str = "y",
                           mode: str = "reference", block_rows: int | None = None,
                           weight: str | None = None, run: str | None = None) -> DataFrame:
    """(cluster, x, y, w, a, b, silhouette) per distinct coordinate.
    ``weight`` names a column of point counts, where ``assign`` is already a
    table of weighted coordinates; ``run`` one that tells independent
    clusterings apart (then ``run`` is the first column of the result)."""
    if mode not in ("reference", "textbook"):
        raise ValueError("mode must be 'reference' or 'textbook'")
    slots = cores(assign.sparkSession)
    # used several times below: materialise once in the shared checkpoint folder
    ensure_checkpoint_dir(assign.sparkSession)
    W = coordinate_weights(assign, cluster, x, y, weight, run).checkpoint(eager=True)
    each = ["run"] if run else []
    stats = _numbered(W, each, block_rows, slots)
    small = F.broadcast if stats.count() <= MAX_BROADCAST_CLUSTERS else (lambda df: df)

    column = F.shiftright(F.col("y").cast("bigint"), COLUMN_BITS)    # rows of a column stay in one group
    coords = W.join(small(stats), [*each, "cluster"]).select(
        *each, "cid", F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), "w",
        (F.col("first") + F.pmod(F.xxhash64("x", column), F.col("nb"))).alias("g"))
    needs = needed_clusters(coords, stats, run).checkpoint(eager=True)
    groups = stats.select("cid", "first", "nb", "d")
    met = needs.groupBy("cid", "rcid").agg(F.count(F.lit(1)).alias("asking"))
    sides = (met.join(small(groups.select("cid", F.col("nb").alias("nq"))), "cid")
             .join(small(groups.select(F.col("cid").alias("rcid"), F.col("nb").alias("nr"), "d")), "rcid"))
    cells, moved, pairs = sides.agg(
        F.sum(F.col("nq") * F.col("nr")), F.sum(F.col("asking") * F.col("nr") + F.col("d") * F.col("nq")),
        F.count(F.lit(1))).first()
    parts = max(1, min(cells or 0, max(4 * slots, math.ceil((moved or 0) * ROW_BYTES / TASK_BYTES))))

    # each query row goes to the groups of the clusters it needs, each reference
    # row to the groups of the clusters that need its own
    key = ["gq", "gr"]
    reach = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("nb") - 1))
    few = F.broadcast if pairs <= MAX_BROADCAST_CLUSTERS else (lambda df: df)
    q_side = (needs.join(small(groups.select(F.col("cid").alias("rcid"), "first", "nb")), "rcid")
              .select(F.col("g").alias("gq"), reach.alias("gr"), *[F.col(c).alias(c) for c in ("cid", "x", "y", "w", "rcid")])
              .repartition(parts, *key))
    asked = met.select(F.col("rcid").alias("cid"), F.col("cid").alias("qcid")).join(
        small(groups.select(F.col("cid").alias("qcid"), "first", "nb")), "qcid")
    r_side = (coords.join(few(asked), "cid")
              .select(reach.alias("gq"), F.col("g").alias("gr"), "cid", "x", "y", "w").repartition(parts, *key))
    partial = (q_side.groupBy(*key).cogroup(r_side.groupBy(*key))
               .applyInPandas(_cell_kernel(), PARTIAL_SCHEMA))
    per = partial.groupBy("cid", "x", "y", "w", "rcid").agg(F.sum("s").alias("s"))

    size = small(stats.select(F.col("cid").alias("rcid"), F.col("n").alias("rn")))
    own = F.col("rcid") == F.col("cid")
    agg = per.join(size, "rcid").groupBy("cid", "x", "y", "w").agg(
        F.max(F.when(own, F.col("s"))).alias("s_own"),
        F.min(F.when(~own, F.col("s") / F.col("rn"))).alias("b"))
    agg = agg.join(small(stats.select(*each, "cid", "cluster", "n")), "cid")
    others = F.col("n") - (F.col("w") if mode == "reference" else F.lit(1))
    a = F.when(others > 0, F.coalesce(F.col("s_own"), F.lit(0.0)) / others).otherwise(F.lit(0.0))
    s = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    if mode == "textbook":
        s = F.when(F.col("n") == 1, F.lit(0.0)).otherwise(s)
    return (agg.withColumn("a", a).withColumn("silhouette", s)
            .select(*each, "cluster", F.col("x").cast(W.schema["x"].dataType).alias("x"),
                    F.col("y").cast(W.schema["y"].dataType).alias("y"), "w", "a", "b", "silhouette"))


def points_from(coords: DataFrame, assign: DataFrame, cluster: str = "pos", x: str = "x", y: str = "y") -> DataFrame:
    """Every row of ``assign`` with its coordinate's ``silhouette``; null for
    the rows that were skipped.  One row per distinct coordinate is joined:
    broadcast when measured small, else a shuffle join whose hot coordinate
    AQE can split."""
    named = coords.select(F.col("cluster").alias(cluster), F.col("x").alias(x), F.col("y").alias(y), "silhouette")
    return assign.join(checked_broadcast(named), [cluster, x, y], "left")


def mean_from(coords: DataFrame, *each: str) -> DataFrame:
    """(clusters, points, mean_silhouette) -- the mean over points is the
    w-weighted mean over coordinates, so points are not touched again.  One
    row for each value of the columns ``each``, if any."""
    return coords.groupBy(*each).agg(
        F.count_distinct("cluster").cast("int").alias("clusters"),
        F.sum("w").alias("points"),
        F.try_divide(F.sum(F.col("w") * F.col("silhouette")),
                     F.sum(F.when(F.col("silhouette").isNotNull(), F.col("w")))).alias("mean_silhouette"))


def silhouette_points(assign: DataFrame, cluster: str = "pos", x: str = "x", y: str = "y",
                      mode: str = "reference", block_rows: int | None = None) -> DataFrame:
    """Every input row with its ``silhouette``.  The quadratic part is written
    once to the checkpoint folder, so neither the size probe nor a lost
    executor makes it run again."""
    coords = silhouette_coordinates(assign, cluster, x, y, mode, block_rows).checkpoint(eager=True)
    return points_from(coords, assign, cluster, x, y)


def silhouette_mean(assign: DataFrame, cluster: str = "pos", x: str = "x", y: str = "y",
                    mode: str = "reference", block_rows: int | None = None, weight: str | None = None,
                    run: str | None = None) -> DataFrame:
    """(clusters, points, mean_silhouette), with ``run`` first where there are
    several clusterings; see :func:`mean_from`."""
    coords = silhouette_coordinates(assign, cluster, x, y, mode, block_rows, weight, run)
    return mean_from(coords, *(["run"] if run else []))
