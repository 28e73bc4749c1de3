"""Edge-table operators for the social reports.

All of them keep bag semantics: a repeated relation counts (and is reported)
once per copy, a self relation counts twice in a degree.  Repeated copies are
added up to a multiplicity (of large tables, within the task they come from
first) and expanded again only at the very end, in bounded pieces, so a pair
that holds a third of all rows never lands in one task as a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import input_bytes
from tessera.session import cores

# A multiplicity is expanded in pieces of at most this many rows.
PIECE_ROWS = 1 << 16
# Pairs are dealt so that a task's share comes from about this much input.
PAIR_INPUT_BYTES = 4 << 20
MAX_PAIR_PARTITIONS = 100_000


def symmetric_edges(assoc: DataFrame, a: str = "person_a", b: str = "person_b") -> DataFrame:
    """(id, friend_id) for both directions of every relation, in one pass
    (the same rows as a UNION ALL of the two projections)."""
    both = F.array(F.struct(F.col(a).alias("id"), F.col(b).alias("friend_id")),
                   F.struct(F.col(b).alias("id"), F.col(a).alias("friend_id")))
    return assoc.select(F.inline(both))


def edge_ends(assoc: DataFrame, a: str = "person_a", b: str = "person_b") -> DataFrame:
    """Every end of every relation, as one ``id`` column."""
    return assoc.select(F.explode(F.array(F.col(a), F.col(b))).alias("id"))


def degree(assoc: DataFrame, a: str = "person_a", b: str = "person_b",
           count_name: str = "relationship_count") -> DataFrame:
    """(id, count) of relation ends.  The count skips null ids like a bag
    COUNT; partial aggregation collapses a hot id inside each map task.  Counts
    are 64-bit: a person holding a third of a large edge table exceeds 2^31."""
    return (edge_ends(assoc, a, b).groupBy("id")
            .agg(F.count("id").alias(count_name)))


def pair_multiplicity(edges: DataFrame, keys=("id", "friend_id"), name: str = "mult") -> DataFrame:
    """Distinct pairs with their number of copies.

    Few pairs repeat, so adding up before the shuffle holds nearly all of a
    task's rows in memory, and the shuffle's own partitions are as large as
    their compressed size allows.  Beyond a partition for each core the pairs
    are therefore dealt first, in partitions that grow in number and not in
    size, and added up there: once by pair and task they come from, so copies
    of a hot pair meet only those of their own task, and once by pair."""
    parts = -(-input_bytes(edges) // PAIR_INPUT_BYTES)
    if not cores(edges.sparkSession) < parts <= MAX_PAIR_PARTITIONS:
        return edges.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    parts = max(parts, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))   # a join on the keys keeps these
    own = (edges.withColumn("_task", F.spark_partition_id()).repartition(parts, *keys, "_task")
           .groupBy(*keys, "_task").agg(F.count(F.lit(1)).alias(name)))
    return own.drop("_task").repartition(parts, *keys).groupBy(*keys).agg(F.sum(name).alias(name))


def visited_pairs(logs: DataFrame) -> DataFrame:
    """Distinct (id, friend_id) = (by_who, what_page) of the access log."""
    return (logs.select(F.col("by_who").alias("id"), F.col("what_page").alias("friend_id"))
            .where(F.col("id").isNotNull() & F.col("friend_id").isNotNull())
            .distinct())


def split_multiplicity(df: DataFrame, mult: str = "mult", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Replace ``mult`` by pieces (``piece``, ``n``) with ``n <= piece_rows``;
    the arrays built here have at most ``mult / piece_rows`` elements."""
    # integer division: exact for any 64-bit multiplicity
    last = F.expr(f"(CAST(`{mult}` AS BIGINT) - 1) div {int(piece_rows)}")
    pieces = F.sequence(F.lit(0).cast("bigint"), last)
    cols = [c for c in df.columns if c != mult]
    out = df.select(*cols, F.col(mult), F.explode(pieces).alias("piece"))
    return out.select(*cols, "piece",
                      F.least(F.lit(piece_rows).cast("bigint"),
                              F.col(mult) - F.col("piece") * F.lit(piece_rows)).alias("n"))


def expand_pieces(df: DataFrame, spread_keys: list[str] | None = None) -> DataFrame:
    """One row per copy.  With ``spread_keys`` the pieces are first rebalanced
    on (keys, piece), so the copies of one hot pair are emitted by many tasks."""
    cols = [c for c in df.columns if c not in ("piece", "n")]
    if spread_keys:
        df = df.hint("rebalance", *spread_keys, "piece")
    return df.select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("_copy")).drop("_copy")
