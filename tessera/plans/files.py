"""Round trips through delimited files.

Each job writes what a stand-in view holds as lines into a folder of its own
under the shared folder, some lines malformed by their key, and reads them
back with the readers the command line uses.  The folders are written when a
job is built, and stay for the rows that are read from them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import kmeans as K
from tessera.plans import clustering as C
from tessera.session import ensure_checkpoint_dir
from tessera.sources import delimited as D
from tessera.sources import standins as S


def shared_file(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder that all executors share."""
    return os.path.join(ensure_checkpoint_dir(spark), f"tessera-{name}-{uuid.uuid4().hex}")


def _broken(line: Column, key: Column, sep: str = ",") -> Column:
    """Of nine lines one with a word in front, one cut behind its second
    field, and one with blanks around its first field."""
    return (F.when(key % 9 == 0, F.concat(F.lit("bad" + sep), line))
            .when(key % 9 == 1, F.substring_index(line, sep, 2))
            .when(key % 9 == 2, F.concat(F.lit("  "), F.regexp_replace(line, f"^([^{sep}]*){sep}", f"$1 {sep} ")))
            .otherwise(line))


def _write_lines(lines: DataFrame, name: str) -> str:
    path = shared_file(lines.sparkSession, name)
    lines.write.text(path)
    return path


def people_file(spark: SparkSession, d: str) -> str:
    people = S.people(spark, d)
    line = D.to_lines_column(["id", "name", "nationality", "country_code", "hobby"])
    return _write_lines(people.select("id", line).select(_broken(F.col("value"), F.col("id")).alias("value")), "people")


def logs_file(spark: SparkSession, d: str) -> str:
    logs = S.logs(spark, d)
    line = D.to_lines_column(["acc_id", "by_who", "what_page", "type_of_access", "access_time"])
    return _write_lines(logs.select("acc_id", line).select(_broken(F.col("value"), F.col("acc_id")).alias("value")), "logs")


def parse_people_lines(spark, d) -> DataFrame:
    """People lines, malformed ones among them, by the reader."""
    return D.read_people(spark, people_file(spark, d))


def file_logs(spark, d) -> DataFrame:
    """Access-log lines, malformed ones among them, by the reader."""
    return D.read_logs(spark, logs_file(spark, d))


def file_associates(spark, d) -> DataFrame:
    """S3: relations through the writer and the reader; both text fields are empty."""
    path = shared_file(spark, "associates")
    D.write_delimited(S.associates(spark, d).withColumns({"date_of_relation": F.lit(None), "description": F.lit(None)}), path)
    return D.read_associates(spark, path)


def bad_lines(spark, d) -> DataFrame:
    """(file, reason, nulls, lines) of the lines that the readers of
    people and logs set aside, by what is null in them."""
    out = None
    for name, path, schema in (("people", people_file(spark, d), D.PEOPLE), ("logs", logs_file(spark, d), D.LOGS)):
        part = D.checked(spark, path, schema).bad.groupBy("reason", "nulls").agg(
            F.count(F.lit(1)).alias("lines")).select(
                F.lit(name).alias("file"), "reason", F.array_join("nulls", ";").alias("nulls"), "lines")
        out = part if out is None else out.unionByName(part)
    return out


def file_points2d(spark, d) -> DataFrame:
    """Point lines, malformed ones among them, and the first round over
    what is valid (the others are skipped and counted)."""
    pts = S.points2d(spark, d)
    line = F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"))
    path = _write_lines(pts.select(_broken(line, F.col("pid")).alias("value")), "points")
    res = K.fit2d(D.read_points2d(spark, path), S.seeds2d(pts, 10), 1, early_stop=False)
    return K.centroids_frame2d(spark, res).select(
        "pos", "x", "y", "size", F.lit(res.points).cast("long").alias("points"), F.lit(res.skipped).cast("long").alias("skipped"))


def file_centroids(spark, d) -> DataFrame:
    """The final centroids through the writer and the seed parser."""
    _, res = C.fit_points2d(spark, d, C.CONV_K, C.CONV_R)
    path = shared_file(spark, "final")
    D.write_delimited(K.centroids_frame2d(spark, res).select("x", "y"), path)
    return D.parse_seeds2d(spark.read.text(path))


def centroid_lines_nd(spark, d) -> DataFrame:
    """``id,c1,...`` lines, some without an id or with a field that is
    no number, as the seed parser reads them: a row for each coordinate, one
    without for a line that is skipped."""
    e = S.points_nd(spark, d)
    fields = F.array_join(F.col("coords").cast("array<string>"), ",")
    line = (F.when(F.col("pid") % 10 == 3, F.concat(F.lit("x,"), fields))
            .when(F.col("pid") % 10 == 4, F.concat_ws(",", F.col("pid").cast("string"), fields, F.lit("?")))
            .when(F.col("pid") % 10 == 5, F.col("pid").cast("string"))
            .otherwise(F.concat_ws(" , ", F.col("pid").cast("string"), fields)))
    rows = D.parse_seeds_nd(spark.read.text(_write_lines(e.select(line.alias("value")), "centroids")))
    coords = F.when(F.col("valid"), F.col("coords"))
    return rows.select("cid", "valid", F.posexplode_outer(coords).alias("j", "value")).select(
        "cid", "valid", (F.col("j") + 1).alias("dim"), F.round("value", 6).alias("value"))


def bad_vectors(spark, d) -> DataFrame:
    """F16: N-D lines of which some are short, long or hold a field that is no
    number: the round over them, with the rows read and skipped."""
    e = S.points_nd(spark, d)
    n, coords = F.size("coords"), F.col("coords").cast("array<string>")
    bent = (F.when(F.col("pid") % 11 == 2, F.slice(coords, F.lit(1), n - 1))
            .when(F.col("pid") % 11 == 5, F.concat(coords, F.array(F.lit("0.5"))))
            .when(F.col("pid") % 11 == 7, F.concat(F.slice(coords, F.lit(1), n - 1), F.array(F.lit("none"))))
            .otherwise(coords))
    path = _write_lines(e.select(F.array_join(bent, ",").alias("value")), "vectors")
    res = K.fit_nd(D.read_points_nd(spark, path), S.seeds_nd(e, C.ND_K), 1, early_stop=False)
    return K.centroids_frame_nd(spark, res).select(
        "cid", "size", "dim", "value", F.lit(res.points).cast("long").alias("points"), F.lit(res.skipped).cast("long").alias("skipped"))


def file_trips(spark, d) -> DataFrame:
    """Trips as a CSV file with a header, read by name and typed."""
    path = shared_file(spark, "trips")
    D.write_trips(S.trips(spark, d), path)
    return D.read_trips(spark, path)


def file_history(spark, d) -> DataFrame:
    """K3: centroids of every round, one folder per round, read back with the
    round from the folder's name."""
    path = shared_file(spark, "rounds")
    D.write_history(C.kmeans_history(spark, d), path)
    return D.read_history(spark, path, "pos int, x int, y int")


def file_clusters(spark, d) -> DataFrame:
    """K5: the final cluster table, laid out by cluster, read back."""
    path = shared_file(spark, "clusters")
    D.write_assignments2d(C.kmeans_assignments(spark, d), path, grouped=True)
    return D.read_assignments2d(spark, path)


QUERIES = {f.__name__: f for f in (
    parse_people_lines, file_logs, file_associates, bad_lines, file_points2d, file_centroids, centroid_lines_nd,
    bad_vectors, file_trips, file_history, file_clusters)}
