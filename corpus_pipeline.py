"""The corpus pipeline: five stages over the documents table.

Each stage works on all documents its predecessor kept and decides for good;
``run`` writes what a stage keeps as Parquet in the shared folder and reads it
back as the next one's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import shared_dir, staged
from tessera.llm.decontamination import find_items
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.mixing import mix
from tessera.llm.ngram_jaccard import jaccard_components
from tessera.llm.queries import TOXIC_CUT, table
from tessera.llm.toxicity import score_toxicity, train_toxicity
from tessera.operators.joins import checked_broadcast


def _packed(docs: DataFrame, *more: str) -> DataFrame:
    """All columns in one struct beside the ones an operator needs, so that
    no column of ``docs`` meets a name of the operator's own."""
    return docs.select(F.struct(*docs.columns).alias("row"), *more)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the cut (operator 5)."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(_packed(docs, "text"), model).where(F.col("score") < TOXIC_CUT).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines another one with a smaller id holds
    too (operator 10); n_chars follows the text, null text stays null."""
    text = F.when(F.col("row")["text"].isNotNull(), F.col("text"))
    new = {"text": text, "n_chars": F.coalesce(F.length(text).cast("long"), F.col("row")["n_chars"])}
    out = dedup_lines(_packed(docs, "doc_id", "text"))
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by the n-gram Jaccard join (operator 8):
    the one with the least id, rows without an id last, of rows that share it
    the one with the least hash of its text.  Documents without words stay:
    they are linked with nothing.  Of rows that repeat with id and text one
    stays, but for those with neither id nor words, which nothing links."""
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.unhex(F.md5("text")).alias("hash"))
    rows = jaccard_components(docs.select(key.alias("key"), "text"), id_col="key")
    marked = rows.groupBy("key", "component_id", "n_shingles").agg(F.count(F.lit(1)).alias("n"))
    marked = staged(marked.where("key <> component_id OR n > 1 AND (n_shingles > 0 OR NOT key.last)")
                    .select("key.doc_id", "key.hash", (F.col("key") == F.col("component_id")).alias("stays")))
    marked = checked_broadcast(marked)      # small beside the corpus, whose texts then stay where they are
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & F.unhex(F.md5("d.text")).eqNullSafe(F.col("m.hash"))
    once = docs.alias("d").join(marked.alias("m"), same, "left_anti")
    again = docs.alias("d").join(marked.where("stays").alias("m"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 6).  Each row and each
    item is judged by its own text, also where they share an id or have none."""
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.unhex(F.md5("text")).alias("item_id"), "text")
    bad = checked_broadcast(staged(find_items(rows, items, id_col="doc").select("doc.*").distinct()))
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("d.text") == F.col("b.hash"))
    return docs.alias("d").join(bad.alias("b"), same, "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document (operator 3)."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_jaccard", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

#: a lexicon learned from labelled rows is not SQL: the tests hold the stages
#: against plain Python versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one has written is deleted once the next one's rows
    are there, so at most two are kept at a time."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/tessera-pipeline-{uuid.uuid4().hex}-{name}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            folder = spark._jvm.org.apache.hadoop.fs.Path(last)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
