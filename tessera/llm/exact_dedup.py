"""Exact dedup by content sort (DataFrame operations only).

The normalised texts are range-partitioned by sampled splitters
(``repartitionByRange``), sorted outside memory within each partition, and
neighbouring rows are compared in full: the window below starts a new group
wherever the whole normalised text differs from the row before it.  A
splitter is the first ``SPLITTER`` characters and a hash of the whole text,
so that the sample stays small however long texts are, and then a salt drawn
from the identifier, so that a group of copies that holds a third of all rows
is cut over many partitions; the runs of one text (at most one per salt) then
meet by SHA-256 in a table of small rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, staged, text_or_empty


#: characters of a text that its splitter shows
SPLITTER = 32


def normalised(text_col: str):
    """Every run of white space becomes one blank.  Only the places where
    that changes something are matched."""
    return F.regexp_replace(text_or_empty(text_col), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts equal each other.  A null id is
    kept only if its group has no other id; of repeated rows with one id and
    equal text exactly one is kept.  Other columns are ignored.
    """
    spark = docs.sparkSession
    salts = 4 * partitions(spark)
    norm = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    keyed = norm.select("*", F.substring("_norm", 1, SPLITTER).alias("_head"), F.xxhash64("_norm").alias("_hash"),
                        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"))
    split = ["_head", "_hash", "_salt"]
    run = Window.partitionBy(*split, "_norm").orderBy(F.col("_id").asc_nulls_last())
    rows = staged(
        keyed.repartitionByRange(*split)
        .select("_id", "_salt", F.sha2("_norm", 256).alias("text_sha256"),
                F.row_number().over(run).alias("_nth")))

    whole = Window.partitionBy("text_sha256")
    runs = (rows.groupBy("text_sha256", "_salt")
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
            .select("text_sha256", "_salt", F.sum("_n").over(whole).alias("group_size"),
                    F.min("_first").over(whole).alias("keep_id")))
    return rows.join(runs, ["text_sha256", "_salt"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        ((F.col("_nth") == 1) & F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256")
