"""Oracle SQL for the k-means jobs, generated as one CTE per round.

Each round is written out: assign (nearest centroid, first in list order on
ties), update (truncating integer mean, or per-dimension mean in N-D),
re-rank by the previous centroid's text, convergence flag.  All ``R`` rounds
are computed; the stop round is the first round >= 2 whose flag is set (early
stop) or ``R``.  DuckDB materialises every round once.
"""

from __future__ import annotations

PTS2D = """pts AS (
  SELECT c_custkey AS pid, CAST(c_nationkey * 400 AS INTEGER) AS x,
         CAST(floor((c_acctbal + 1000) * 10 / 11) AS INTEGER) AS y
  FROM customer)"""


def _d2(px, py, cx, cy):
    return (f"(CAST({px} AS BIGINT) - {cx}) * (CAST({px} AS BIGINT) - {cx}) + "
            f"(CAST({py} AS BIGINT) - {cy}) * (CAST({py} AS BIGINT) - {cy})")


def kmeans2d_ctes(k: int, rounds: int, threshold: float = 0.5, early_stop: bool = True) -> list[str]:
    """CTEs ending in ``hist(iteration, pos, x, y, size)``, ``stop(iters,
    converged)`` and ``fin(pos, x, y, size)``."""
    ctes = [PTS2D, f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY pid) - 1 AS INTEGER) AS pos, x, y
  FROM (SELECT pid, x, y FROM pts ORDER BY pid LIMIT {k}) s)"""]
    for r in range(1, rounds + 1):
        prev = "c0" if r == 1 else f"n{r-1}"
        ctes.append(f"""a{r} AS MATERIALIZED (
  SELECT p.pid, p.x, p.y, c.pos FROM pts p CROSS JOIN {prev} c
  QUALIFY row_number() OVER (PARTITION BY p.pid ORDER BY {_d2('p.x', 'p.y', 'c.x', 'c.y')}, c.pos) = 1)""")
        ctes.append(f"""n{r} AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY CAST(o.x AS VARCHAR) || ',' || CAST(o.y AS VARCHAR)) - 1 AS INTEGER) AS pos,
         CAST(s.sx // s.n AS INTEGER) AS x, CAST(s.sy // s.n AS INTEGER) AS y, s.n AS size
  FROM (SELECT pos, CAST(sum(x) AS BIGINT) AS sx, CAST(sum(y) AS BIGINT) AS sy, count(*) AS n
        FROM a{r} GROUP BY pos) s
  JOIN {prev} o ON o.pos = s.pos)""")
        ctes.append(f"""v{r} AS MATERIALIZED (
  SELECT {r} AS r, coalesce(bool_and(md <= {threshold}), true) AS conv FROM (
    SELECT n.pos, min(sqrt(CAST({_d2('n.x', 'n.y', 'o.x', 'o.y')} AS DOUBLE))) AS md
    FROM n{r} n CROSS JOIN {prev} o GROUP BY n.pos) t)""")
    ctes.append("hist AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT {r} AS iteration, pos, x, y, size FROM n{r}" for r in range(1, rounds + 1)) + ")")
    ctes.append("flags AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT r, conv FROM v{r}" for r in range(1, rounds + 1)) + ")")
    if early_stop:
        ctes.append(f"""stop AS (
  SELECT CAST(coalesce(min(r) FILTER (WHERE conv AND r >= 2), {rounds}) AS INTEGER) AS iters,
         min(r) FILTER (WHERE conv AND r >= 2) IS NOT NULL AS converged
  FROM flags)""")
    else:
        ctes.append(f"""stop AS (
  SELECT CAST({rounds} AS INTEGER) AS iters, conv AS converged FROM flags WHERE r = {rounds})""")
    ctes.append("fin AS (SELECT pos, x, y, size FROM hist WHERE iteration = (SELECT iters FROM stop))")
    return ctes


def _with(ctes: list[str]) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def kmeans2d_centroids_sql(k: int, rounds: int, threshold: float = 0.5, early_stop: bool = True) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, early_stop)) + """
SELECT f.pos, f.x, f.y, f.size, s.iters AS iterations, s.converged
FROM fin f CROSS JOIN stop s"""


def assignments_cte(fin: str = "fin", name: str = "assign") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT p.pid, p.x, p.y, c.pos, c.x AS cx, c.y AS cy FROM pts p CROSS JOIN {fin} c
  QUALIFY row_number() OVER (PARTITION BY p.pid ORDER BY {_d2('p.x', 'p.y', 'c.x', 'c.y')}, c.pos) = 1)"""


def kmeans2d_assignments_sql(k: int, rounds: int, threshold: float = 0.5) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, True) + [assignments_cte()]) + """
SELECT pid, x, y, pos, cx, cy FROM assign"""


def kmeans2d_history_sql(k: int, rounds: int, threshold: float = 0.5, early_stop: bool = True) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, early_stop)) + """
SELECT iteration, pos, x, y FROM hist WHERE iteration <= (SELECT iters FROM stop)"""


def cluster_profile_sql(k: int, rounds: int, threshold: float = 0.5) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, True) + [assignments_cte()]) + """
SELECT pos, cx, cy, count(*) AS points, count(DISTINCT (x, y)) AS distinct_points
FROM assign GROUP BY pos, cx, cy"""


# ---------------------------------------------------------------- N-D

def kmeans_nd_ctes(k: int, rounds: int, dim: int, threshold: float = 0.01, criterion: str = "any",
                   early_stop: bool = True) -> list[str]:
    agg = "bool_or" if criterion == "any" else "bool_and"
    ctes = [f"""ptsn AS (
  SELECT vec_id AS pid, CAST(embedding AS DOUBLE[]) AS coords FROM embeddings WHERE len(embedding) = {dim})""",
            f"""m0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY pid) - 1 AS INTEGER) AS pos, CAST(pid AS INTEGER) AS cid, coords,
         CAST(NULL AS BIGINT) AS n
  FROM (SELECT pid, coords FROM ptsn ORDER BY pid LIMIT {k}) s)"""]
    for r in range(1, rounds + 1):
        prev = f"m{r-1}"
        ctes.append(f"""b{r} AS MATERIALIZED (
  SELECT p.pid, p.coords, c.cid FROM ptsn p CROSS JOIN {prev} c
  QUALIFY row_number() OVER (PARTITION BY p.pid ORDER BY list_distance(p.coords, c.coords), c.pos) = 1)""")
        ctes.append(f"""m{r} AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY CAST(d.cid AS VARCHAR)) - 1 AS INTEGER) AS pos, d.cid, d.coords, s.n
  FROM (SELECT cid, list(m ORDER BY i) AS coords
        FROM (SELECT cid, i, avg(v) AS m
              FROM (SELECT cid, generate_subscripts(coords, 1) AS i, unnest(coords) AS v FROM b{r}) u
              GROUP BY cid, i) t
        GROUP BY cid) d
  JOIN (SELECT cid, count(*) AS n FROM b{r} GROUP BY cid) s ON s.cid = d.cid)""")
        if criterion == "any":
            flag = f"coalesce({agg}(list_distance(c.coords, o.coords) <= {threshold}), false)"
        else:
            flag = (f"coalesce({agg}(o.cid IS NOT NULL AND list_distance(c.coords, o.coords) <= {threshold}), false)")
        ctes.append(f"""w{r} AS MATERIALIZED (
  SELECT {r} AS r, {flag} AS conv FROM m{r} c LEFT JOIN {prev} o ON c.cid = o.cid)""")
    ctes.append("nflags AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT r, conv FROM w{r}" for r in range(1, rounds + 1)) + ")")
    first = "min(r) FILTER (WHERE conv AND r >= 2)"
    iters = f"coalesce({first}, {rounds})" if early_stop else str(rounds)
    ctes.append(f"""nstop AS (
  SELECT CAST({iters} AS INTEGER) AS iters, {first} IS NOT NULL AS converged FROM nflags)""")
    ctes.append("nhist AS (\n  " + "\n  UNION ALL ".join(
        f"SELECT {r} AS iteration, pos, cid, coords, n FROM m{r}" for r in range(1, rounds + 1)) + ")")
    ctes.append("nfin AS (SELECT pos, cid, coords, n FROM nhist WHERE iteration = (SELECT iters FROM nstop))")
    return ctes


def kmeans_nd_sql(k: int, rounds: int, dim: int, threshold: float = 0.01, criterion: str = "any",
                  early_stop: bool = True) -> str:
    return _with(kmeans_nd_ctes(k, rounds, dim, threshold, criterion, early_stop)) + """
SELECT f.cid, f.n AS size, CAST(generate_subscripts(f.coords, 1) AS INTEGER) AS dim, round(unnest(f.coords), 6) AS value,
       s.iters AS iterations, s.converged
FROM nfin f CROSS JOIN nstop s"""


def kmeans_nd_history_sql(k: int, rounds: int, dim: int, threshold: float = 0.01) -> str:
    return _with(kmeans_nd_ctes(k, rounds, dim, threshold, "any", True)) + """
SELECT CAST(iteration AS INTEGER) AS iteration, cid, CAST(generate_subscripts(coords, 1) AS INTEGER) AS dim,
       round(unnest(coords), 6) AS value
FROM nhist WHERE iteration <= (SELECT iters FROM nstop)"""


def silhouette_ctes(mode: str = "reference", src: str = "assign", sfx: str = "") -> list[str]:
    """Per-coordinate silhouette over ``src`` (all pairs of distinct
    coordinates: the oracle may be quadratic); CTE names end in ``sfx``."""
    if mode == "reference":
        a = "CASE WHEN n.n - ab.w > 0 THEN coalesce(ab.s_own, 0) / (n.n - ab.w) ELSE 0 END"
        sil = "(b - a) / greatest(a, b)"
    else:
        a = "CASE WHEN n.n - 1 > 0 THEN coalesce(ab.s_own, 0) / (n.n - 1) ELSE 0 END"
        sil = "CASE WHEN n_own = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END"
    return [
        f"cw{sfx} AS MATERIALIZED (SELECT pos AS cluster, x, y, count(*) AS w FROM {src} GROUP BY pos, x, y)",
        f"cn{sfx} AS MATERIALIZED (SELECT cluster, CAST(sum(w) AS BIGINT) AS n FROM cw{sfx} GROUP BY cluster)",
        f"""css{sfx} AS MATERIALIZED (
  SELECT q.cluster, q.x, q.y, q.w, r.cluster AS rcluster,
         sum(r.w * sqrt(CAST({_d2('q.x', 'q.y', 'r.x', 'r.y')} AS DOUBLE))) AS s
  FROM cw{sfx} q CROSS JOIN cw{sfx} r GROUP BY q.cluster, q.x, q.y, q.w, r.cluster)""",
        f"""cab{sfx} AS MATERIALIZED (
  SELECT c.cluster, c.x, c.y, c.w,
         max(CASE WHEN c.rcluster = c.cluster THEN c.s END) AS s_own,
         min(CASE WHEN c.rcluster <> c.cluster THEN c.s / n.n END) AS b
  FROM css{sfx} c JOIN cn{sfx} n ON n.cluster = c.rcluster GROUP BY c.cluster, c.x, c.y, c.w)""",
        f"""csc{sfx} AS MATERIALIZED (
  SELECT ab.cluster, ab.x, ab.y, ab.w, ab.b, n.n AS n_own, {a} AS a
  FROM cab{sfx} ab JOIN cn{sfx} n ON n.cluster = ab.cluster)""",
        f"sil{sfx} AS MATERIALIZED (SELECT cluster, x, y, w, {sil} AS silhouette FROM csc{sfx})",
    ]


def silhouette_points_sql(k: int, rounds: int, threshold: float = 0.5, mode: str = "reference") -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, True) + [assignments_cte()] + silhouette_ctes(mode)) + """
SELECT a.pid, a.x, a.y, a.pos, round(s.silhouette, 6) AS silhouette
FROM assign a JOIN sil s ON s.cluster = a.pos AND s.x = a.x AND s.y = a.y"""


def silhouette_mean_sql(k: int, rounds: int, threshold: float = 0.5, mode: str = "reference") -> str:
    mean = ("sum(w * silhouette) / sum(CASE WHEN silhouette IS NOT NULL THEN w END)")
    return _with(kmeans2d_ctes(k, rounds, threshold, True) + [assignments_cte()] + silhouette_ctes(mode)) + f"""
SELECT CAST(count(DISTINCT cluster) AS INTEGER) AS clusters, CAST(sum(w) AS BIGINT) AS points,
       round({mean}, 6) AS mean_silhouette, printf('%.4f', {mean}) AS mean_text
FROM sil"""


def sweep_sql(ks, rounds, threshold: float = 0.5) -> str:
    """One round chain per k up to the largest limit; each limit R takes the
    first converged round in 2..R (or R) from that chain, then assigns and
    scores it."""
    parts = []
    mean = "sum(w * silhouette) / sum(CASE WHEN silhouette IS NOT NULL THEN w END)"
    top = max(rounds)
    for k in ks:
        ctes = kmeans2d_ctes(k, top, threshold, True)
        selects = []
        for r in rounds:
            first = f"min(r) FILTER (WHERE conv AND r >= 2 AND r <= {r})"
            ctes += [f"""stop_{r} AS (
  SELECT CAST(coalesce({first}, {r}) AS INTEGER) AS iters, {first} IS NOT NULL AS converged FROM flags)""",
                     f"fin_{r} AS (SELECT pos, x, y, size FROM hist WHERE iteration = (SELECT iters FROM stop_{r}))",
                     assignments_cte(f"fin_{r}", f"assign_{r}")]
            ctes += silhouette_ctes("reference", f"assign_{r}", f"_{r}")
            selects.append(f"""SELECT CAST({k} AS INTEGER) AS k, CAST({r} AS INTEGER) AS max_iter,
       (SELECT iters FROM stop_{r}) AS iterations, (SELECT converged FROM stop_{r}) AS converged,
       CAST(count(DISTINCT cluster) AS INTEGER) AS clusters, round({mean}, 6) AS mean_silhouette
FROM sil_{r}""")
        parts.append("SELECT * FROM (" + _with(ctes) + "\nUNION ALL\n".join(selects) + ")")
    return "\nUNION ALL\n".join(parts)


def kmeans_nd_assignments_sql(k: int, rounds: int, dim: int, threshold: float = 0.01) -> str:
    return _with(kmeans_nd_ctes(k, rounds, dim, threshold, "any", True)) + """
SELECT p.pid, c.cid FROM ptsn p CROSS JOIN nfin c
QUALIFY row_number() OVER (PARTITION BY p.pid ORDER BY list_distance(p.coords, c.coords), c.pos) = 1"""


def kmeans2d_final_lines_sql(k: int, rounds: int, threshold: float = 0.5) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, True)) + "SELECT x, y, true AS valid FROM fin"


def kmeans2d_cluster_lines_sql(k: int, rounds: int, threshold: float = 0.5) -> str:
    return _with(kmeans2d_ctes(k, rounds, threshold, True) + [assignments_cte()]) + "SELECT cx, cy, x, y FROM assign"


def file_points_sql(k: int) -> str:
    """One round over the point lines: a ninth lost its integers (a word in
    front shifts the fields), none lost a field by the cut."""
    one = kmeans2d_ctes(k, 1, early_stop=False)
    one[0] = one[0].replace("pts AS", "given AS", 1)
    one.insert(1, "pts AS (SELECT * FROM given WHERE pid % 9 <> 0)")
    one[2] = one[2].replace("FROM pts", "FROM given")
    return _with(one) + """
SELECT pos, x, y, size, (SELECT count(*) FROM given) AS points, (SELECT count(*) FROM given WHERE pid % 9 = 0) AS skipped
FROM n1"""


def bad_vectors_sql(k: int, dim: int) -> str:
    """One N-D round without the vectors that are short, long or hold text."""
    one = kmeans_nd_ctes(k, 1, dim, early_stop=False)
    one[0] = one[0].replace("ptsn AS", "given AS", 1)
    one.insert(1, "ptsn AS (SELECT * FROM given WHERE pid % 11 NOT IN (2, 5, 7))")
    one[2] = one[2].replace("FROM ptsn", "FROM given")
    return _with(one) + """
SELECT cid, n AS size, CAST(generate_subscripts(coords, 1) AS INTEGER) AS dim, round(unnest(coords), 6) AS value,
       (SELECT count(*) FROM given) AS points, (SELECT count(*) FROM given WHERE pid % 11 IN (2, 5, 7)) AS skipped
FROM m1"""
