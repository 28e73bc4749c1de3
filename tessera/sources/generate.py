"""Seeded 2-D points with integer coordinates in 0..10000, both included.

Each row of a key column gets a point from a hash of (seed, key, axis), so
the result does not depend on partitioning and is the same on every retry,
and the number of points grows with the table the keys come from.  The hash
is the first 52 bits of the MD5 of ``seed:key:axis``, modulo 10001: a mixing
hash that other engines have too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.delimited import write_delimited

from tessera.fixed import COORD_MAX  # noqa: E402


def _uniform_int(seed: int, key, axis: int, hi: int = COORD_MAX):
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(str(axis)))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (bits % F.lit(hi + 1)).cast("int")


def points_from_keys(keys: DataFrame, key: str, seed: int = 7) -> DataFrame:
    """(pid, x, y): one random point per key row."""
    k = F.col(key)
    return keys.select(k.alias("pid"), _uniform_int(seed, k, 0).alias("x"), _uniform_int(seed, k, 1).alias("y"))


def points_range(spark: SparkSession, n: int, seed: int = 7) -> DataFrame:
    """(pid, x, y) for pid in 0..n-1."""
    return points_from_keys(spark.range(n).withColumnRenamed("id", "pid"), "pid", seed)


def write_points(points: DataFrame, path: str) -> None:
    """Points file: written once, an existing file is kept."""
    write_delimited(points.select("x", "y"), path, mode="ignore")


def write_seeds(seeds: DataFrame, path: str) -> None:
    """Seed file: replaced on every call."""
    write_delimited(seeds.select("x", "y"), path, mode="overwrite")
