"""Benchmark decontamination (DataFrame operations only).

Finds short test items inside long documents: pairs in which a document holds
at least ``threshold`` of an item's distinct five-word shingles.

Search by size-partitioned MinHash sketches: items are partitioned by the
power of two above their number of shingles, and the sketch of an item is its
``k`` smallest shingle hashes, where ``k = floor((1 - threshold) * size) + 1``
for the largest size of the partition.  A document that holds the threshold
of an item's shingles lacks fewer than ``k`` of them, so at least one value of
the sketch is among its hashes: the candidates, the pairs in which a sketch
value is met, miss no pair.  The share of the sketch that is met estimates
the containment (``sketch_containment``); candidates are verified by counting
the item's shingles in the document, compared word by word.

Documents are read once and never shuffled; their shingles meet the items'
table where they are made, and one row for each pair and task leaves it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, checked_small, text_or_empty

WORDS = 5
THRESHOLD = 0.75
#: an item table of up to so many shingles is broadcast (about 100 bytes each)
MAX_BROADCAST = 500_000


def words(text_col: str):
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text_or_empty(text_col)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingles(df: DataFrame, keep: list) -> DataFrame:
    """A row for each place of ``WORDS`` words of column ``_words``: the kept
    columns, hash ``_h`` and the words ``_s``."""
    at = [F.get("_words", F.col("_at") + i) for i in range(WORDS)]
    return (df.where(F.size("_words") >= WORDS).select("*", F.posexplode("_words").alias("_at", "_w"))
            .where(F.col("_at") <= F.size("_words") - WORDS)
            .select(*keep, F.xxhash64(*at).alias("_h"), F.concat_ws(" ", *at).alias("_s")))


def sketches(items: DataFrame, item_id: str = "item_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """(item, _h, _s, size, k, in_sketch): the items' distinct shingles.

    Items of the same id are taken together as one; an item of null id, or of
    fewer than five words, has no shingles and is found nowhere.
    """
    s = (shingles(items.where(F.col(item_id).isNotNull())
                  .select(F.col(item_id).alias("_item"), words(text_col).alias("_words")), ["_item"])
         .distinct())
    sized = s.groupBy("_item").agg(F.count(F.lit(1)).alias("size"), F.sort_array(F.collect_list("_h")).alias("_all"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("size").cast("double"))))
    sized = sized.select("_item", "size", "_all", F.least(
        F.col("size"), (F.floor(F.lit(1 - threshold) * upper + 1e-9) + 1)).cast("int").alias("k"))
    return s.join(sized.select("_item", "size", "k", F.element_at("_all", F.col("k")).alias("_top")), "_item").select(
        "_item", "_h", "_s", "size", "k", (F.col("_h") <= F.col("_top")).alias("in_sketch"))


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc, item, n_shingles, n_found, containment, sketch_containment): the
    pairs at or above ``threshold``.

    Rows of one document id count as one document, a null id as another; null
    and empty texts hold nothing.  Other columns of both tables are ignored.
    """
    index = sketches(items, item_id, item_text, threshold)
    index = checked_small(index, MAX_BROADCAST)
    rows = shingles(docs.select(F.col(id_col).alias("_doc"), words(text_col).alias("_words")), ["_doc"])
    met = rows.join(index, ["_h", "_s"])
    pair = met.groupBy("_doc", "_item", "_h", "_s").agg(
        F.first("size").alias("size"), F.first("k").alias("k"), F.first("in_sketch").alias("in_sketch"))
    found = pair.groupBy("_doc", "_item").agg(
        F.first("size").alias("n_shingles"), F.first("k").alias("_k"), F.count(F.lit(1)).alias("n_found"),
        F.count_if("in_sketch").alias("_met"))
    return (found.where("_met > 0").where(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles"))
            .select(F.col("_doc").alias(id_col), F.col("_item").alias(item_id), "n_shingles", "n_found",
                    (F.col("n_found") / F.col("n_shingles")).alias("containment"),
                    (F.col("_met") / F.col("_k")).alias("sketch_containment")))
