"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (through the stand-in views), so its
work grows with the data.  The matching oracle SQL is in
:mod:`tessera.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import clustering as C
from tessera.plans import kmeans_sql as KS
from tessera.plans import files, oracle, reports
from tessera.plans import trips as TR
from tessera.sources import delimited as D
from tessera.sources import standins as S


def _people(spark, d):
    return S.people(spark, d)


def q_filter_project_nationality(spark: SparkSession, d: str) -> DataFrame:
    return reports.nationality_people(_people(spark, d), oracle.NATIONALITY)


def q_format_people_lines(spark, d):
    """People as the delimited lines the writer makes."""
    return D.to_lines(_people(spark, d))


def q_parse_assignment_lines(spark, d):
    """Assignment lines of the points, some malformed, read back; rows with a
    null are what the silhouette skips and counts."""
    p = S.points2d(spark, d)
    number = F.when(F.col("pid") % 7 == 3, F.lit("x")).otherwise(F.col("x").cast("string"))
    tab = F.when(F.col("pid") % 11 == 5, F.lit(" ")).otherwise(F.lit("\t"))
    lines = p.select(F.concat(F.col("y").cast("string"), F.lit(","), F.col("x").cast("string"), tab, number, F.lit(", "),
                              F.col("y").cast("string")).alias("value"))
    whole = F.forall(F.array("cx", "cy", "x", "y"), lambda v: v.isNotNull())
    return D.parse_assignments2d(lines).withColumn("skipped", ~whole)


def q_top_pages(spark, d):
    return reports.top_pages(_people(spark, d), S.logs(spark, d), 10)


def q_people_per_nationality(spark, d):
    return reports.people_per_nationality(_people(spark, d))


def q_relationship_degree(spark, d):
    return reports.relationship_degree(_people(spark, d), S.associates(spark, d))


def q_access_profile(spark, d):
    return reports.access_profile(_people(spark, d), S.logs(spark, d))


def q_unvisited_friends(spark, d):
    return reports.unvisited_friends(_people(spark, d), S.associates(spark, d), S.logs(spark, d))


def q_friend_page_visits(spark, d):
    return reports.friend_page_visits(S.associates(spark, d), S.logs(spark, d))


def q_latest_access_threshold(spark, d):
    return reports.latest_access(_people(spark, d), S.logs(spark, d), oracle.LATEST_THRESHOLD, "text")


def q_latest_access_numeric(spark, d):
    return reports.latest_access(_people(spark, d), S.logs(spark, d), oracle.LATEST_THRESHOLD, "numeric")


def q_degree_summary(spark, d):
    return reports.degree_summary(S.associates(spark, d))


def q_above_average_degree(spark, d):
    return reports.above_average_degree(_people(spark, d), S.associates(spark, d))


def q_trip_features(spark, d):
    return TR.trip_features(S.trips(spark, d))


def q_mean_card_tip(spark, d):
    return TR.mean_card_tip(S.trips(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "filter_project_nationality": q_filter_project_nationality,
        "top_pages": q_top_pages,
        "people_per_nationality": q_people_per_nationality,
        "relationship_degree": q_relationship_degree,
        "access_profile": q_access_profile,
        "unvisited_friends": q_unvisited_friends,
        "friend_page_visits": q_friend_page_visits,
        "latest_access_threshold": q_latest_access_threshold,
        "latest_access_numeric": q_latest_access_numeric,
        "degree_summary": q_degree_summary,
        "above_average_degree": q_above_average_degree,
        "kmeans_step": C.kmeans_step,
        "kmeans_fixed_rounds": C.kmeans_fixed_rounds,
        "kmeans_converged": C.kmeans_converged,
        "kmeans_partial_sums": C.kmeans_partial_sums,
        "kmeans_assignments": C.kmeans_assignments,
        "kmeans_history": C.kmeans_history,
        "cluster_profile": C.cluster_profile,
        "kmeans_nd": C.kmeans_nd,
        "kmeans_nd_all": C.kmeans_nd_all,
        "kmeans_nd_step": C.kmeans_nd_step,
        "kmeans_nd_fixed": C.kmeans_nd_fixed,
        "kmeans_nd_assignments": C.kmeans_nd_assignments,
        "silhouette_points": C.silhouette_points,
        "silhouette_mean": C.silhouette_mean,
        "silhouette_mean_textbook": C.silhouette_mean_textbook,
        "kmeans_sweep": C.kmeans_sweep,
        "generate_points": C.generate_points,
        "generate_seeds": C.generate_seeds,
        "kmeans_nd_history": C.kmeans_nd_history,
        "format_people_lines": q_format_people_lines,
        "parse_assignment_lines": q_parse_assignment_lines,
        "trip_features": q_trip_features,
        "mean_card_tip": q_mean_card_tip,
        **files.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    sql = dict(oracle.report_sql())
    sql.update({
        "kmeans_step": KS.kmeans2d_centroids_sql(C.STEP_K, 1, C.THRESHOLD_2D, early_stop=False),
        "kmeans_fixed_rounds": KS.kmeans2d_centroids_sql(C.FIXED_K, C.FIXED_R, C.THRESHOLD_2D, early_stop=False),
        "kmeans_converged": KS.kmeans2d_centroids_sql(C.CONV_K, C.CONV_R, C.THRESHOLD_2D),
        "kmeans_partial_sums": KS.kmeans2d_centroids_sql(C.PARTIAL_K, C.PARTIAL_R, C.THRESHOLD_2D),
        "kmeans_assignments": KS.kmeans2d_assignments_sql(C.ASSIGN_K, C.ASSIGN_R, C.THRESHOLD_2D),
        "kmeans_history": KS.kmeans2d_history_sql(C.HISTORY_K, C.HISTORY_R, C.THRESHOLD_2D, early_stop=False),
        "cluster_profile": KS.cluster_profile_sql(C.SIL_K, C.SIL_R, C.THRESHOLD_2D),
        "kmeans_nd": KS.kmeans_nd_sql(C.ND_K, C.ND_R, C.ND_DIM, C.ND_THRESHOLD, "any"),
        "kmeans_nd_all": KS.kmeans_nd_sql(C.ND_K, C.ND_R, C.ND_DIM, C.ND_THRESHOLD, "all"),
        "kmeans_nd_step": KS.kmeans_nd_sql(C.ND_K, 1, C.ND_DIM, C.ND_THRESHOLD, "any", early_stop=False),
        "kmeans_nd_fixed": KS.kmeans_nd_sql(C.ND_K, C.ND_R, C.ND_DIM, C.ND_THRESHOLD, "any", early_stop=False),
        "kmeans_nd_assignments": KS.kmeans_nd_assignments_sql(C.ND_K, C.ND_R, C.ND_DIM, C.ND_THRESHOLD),
        "silhouette_points": KS.silhouette_points_sql(C.SIL_K, C.SIL_R, C.THRESHOLD_2D),
        "silhouette_mean": KS.silhouette_mean_sql(C.SIL_K, C.SIL_R, C.THRESHOLD_2D),
        "silhouette_mean_textbook": KS.silhouette_mean_sql(C.SIL_K, C.SIL_R, C.THRESHOLD_2D, "textbook"),
        "kmeans_sweep": KS.sweep_sql(C.SWEEP_K, C.SWEEP_R, C.THRESHOLD_2D),
    })
    sql.update(oracle.trips_sql())
    sql["generate_points"] = oracle.generate_sql()
    sql["generate_seeds"] = oracle.generate_seeds_sql(C.FIXED_K)
    sql["kmeans_nd_history"] = KS.kmeans_nd_history_sql(C.ND_K, C.ND_R, C.ND_DIM, C.ND_THRESHOLD)
    sql |= oracle.lines_sql()
    sql |= oracle.files_sql()
    sql["file_history"] = sql["kmeans_history"]
    sql["file_centroids"] = KS.kmeans2d_final_lines_sql(C.CONV_K, C.CONV_R, C.THRESHOLD_2D)
    sql["file_clusters"] = KS.kmeans2d_cluster_lines_sql(C.ASSIGN_K, C.ASSIGN_R, C.THRESHOLD_2D)
    sql["file_points2d"] = KS.file_points_sql(C.STEP_K)
    sql["bad_vectors"] = KS.bad_vectors_sql(C.ND_K, C.ND_DIM)
    return sql
