"""Connected components of an edge table, by large-star and small-star rounds.

Edges stay distributed; the driver sees one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _lowest(edges: DataFrame) -> DataFrame:
    """(a, b, m): each edge with the least end of node a's edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node each node of ``edges`` (a, b) reaches.
    Nodes without an edge to another node are left out."""
    down = staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_lowest(both).select("a", "b", F.least("a", "m").alias("m")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        down = staged(_lowest(large).select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        now = down.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    return down.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        down.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
