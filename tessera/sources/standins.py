"""Stand-in inputs derived from the driver's parquet tables.

The reference reads three social CSV tables, 2-D / N-D point files and a trip
CSV.  These views give the same shapes from the TPC-H-like tables, so every
job runs over whole tables and grows with them:

* ``people``      customer joined to nation
* ``logs``        events (page from ``props.k``, time as text of seconds)
* ``associates``  orders joined to lineitem (customer -- supplier)
* ``points2d``    customer (nation * 400, scaled account balance)
* ``points_nd``   embeddings (``array<double>``)
* ``trips``       events (pickup, dropoff, payment code, amounts)

Timestamps stay ``timestamp_ntz`` throughout, so no session time zone enters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.joins import checked_broadcast

EPOCH_2024 = "TIMESTAMP_NTZ'2024-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, nationality, country_code, hobby)."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = cust.join(checked_broadcast(nation), cust["c_nationkey"] == nation["n_nationkey"], "inner")
    return joined.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("n_name").alias("nationality"), F.col("c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("hobby"))


def _seconds_since_2024(ts: str = "ts"):
    return F.expr(f"timestampdiff(SECOND, {EPOCH_2024}, {ts})")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(acc_id, by_who, what_page, type_of_access, access_time text)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("acc_id"), F.col("user_id").alias("by_who"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("what_page"),
        F.col("event_type").alias("type_of_access"),
        _seconds_since_2024().cast("string").alias("access_time"))


def associates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rel_id, person_a, person_b): one relation per order line."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    j = checked_broadcast(o).join(li, o["o_orderkey"] == li["l_orderkey"], "inner")
    return j.select((F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("rel_id"),
                    F.col("o_custkey").alias("person_a"), F.col("l_suppkey").alias("person_b"))


def points2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, x, y) integer points."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("pid"), (F.col("c_nationkey") * 400).cast("int").alias("x"),
                    F.floor((F.col("c_acctbal") + 1000) * 10 / 11).cast("int").alias("y"))


def points_nd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pid, coords array<double>)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("pid"), F.col("embedding").cast("array<double>").alias("coords"))


def first_points(points: DataFrame, k: int, order_col: str = "pid") -> DataFrame:
    """The k points with the smallest id (a top-k, not a sample)."""
    return points.orderBy(order_col).limit(k)


def seeds2d(points: DataFrame, k: int) -> list[tuple[int, int]]:
    """Seeds = the k smallest pid, in pid order (k rows to the driver)."""
    return [(int(r["x"]), int(r["y"])) for r in first_points(points, k).select("x", "y").collect()]


def seeds_nd(points: DataFrame, k: int) -> list[tuple[int, list[float]]]:
    """Seeds = the k smallest pid; the centroid id is the pid."""
    rows = first_points(points, k).select("pid", "coords").collect()
    return [(int(r["pid"]), [float(v) for v in r["coords"]]) for r in rows]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-shaped rows; coordinates are made from the key, user and value.
    The two times are parsed from text, as the trip reader parses them."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    pickup = F.expr(f"timestampadd(SECOND, timestampdiff(SECOND, {EPOCH_2024}, ts), {EPOCH_2024})")
    payment = (F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2)
               .when(F.col("event_type") == "view", 3).when(F.col("event_type") == "signup", 4))
    as_text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    base = ev.select(pickup.alias("tpep_pickup_datetime"), k.alias("k"), "user_id", "value", "event_type")
    return base.select(
        F.trim(as_text(F.col("tpep_pickup_datetime"))).try_cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.trim(as_text(F.timestamp_add("SECOND", F.col("k") * 60 + 7, F.col("tpep_pickup_datetime"))))
        .try_cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        (F.col("user_id") % 7).cast("int").alias("passenger_count"),
        F.col("value").alias("trip_distance"),
        (F.col("k") - 50.0).alias("pickup_longitude"), (F.col("user_id") % 90 - 45.0).alias("pickup_latitude"),
        (F.col("k") % 40 - 20.0).alias("dropoff_longitude"), (F.col("value") - F.col("user_id")).alias("dropoff_latitude"),
        payment.alias("payment_type"),
        F.when(F.col("event_type") == "purchase", F.col("k") % 5).otherwise(F.lit(0)).cast("double").alias("tip_amount"),
        (F.col("k") % 3).cast("double").alias("tolls_amount"),
        (F.col("value") + F.col("k")).alias("total_amount"))
