"""Helpers shared by the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: the six white-space bytes every contract names: blank and 0x09 to 0x0D
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
#: a run of letters, digits and non-ASCII characters of lower-cased text
WORD_RUN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_LONG = 9223372036854775807


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors share (``spark.checkpoint.dir``; a scratch folder
    only for a local master that sets none)."""
    return ensure_checkpoint_dir(spark)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, so that a lost executor costs a re-read and not a recomputation,
    and lets several consumers read one result."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"tessera-llm-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, everything else untouched."""
    return F.translate(col, UPPER, LOWER)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checked_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only when a bounded count proves at most ``max_rows``
    rows; otherwise the plain table, which Spark joins by shuffling."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def held_out(id_col: str) -> Column:
    """Rows kept from every training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(texts: DataFrame, classes: Column | DataFrame, per_class: int, rank: list[Column]) -> DataFrame:
    """(_id, _t, _y): at most ``per_class`` different rows of each class of
    ``texts`` (_id, _t, ..), the first by ``rank``, then id, then a hash of the
    text.  ``classes`` is the class as a column of ``texts`` or a table (_id, _y).

    Rows are told apart by id and text, so an id that many rows share gives
    only as many as are picked, and a row that repeats is picked once.  Ranks
    are taken without the texts, each task keeping the first of its own; one
    more scan fetches the texts of the picked rows, and only those move.
    """
    texts = texts.withColumn("_h", F.xxhash64("_t"))
    ranks = [r.alias(f"_r{i}") for i, r in enumerate(rank)]
    if isinstance(classes, DataFrame):
        keys = texts.select("_id", "_h", *ranks).join(classes, "_id")
    else:
        keys = texts.select("_id", "_h", *ranks, classes.alias("_y"))
    order = Window.partitionBy("_y").orderBy(*[f"_r{i}" for i in range(len(rank))], "_id", "_h")
    picked = (keys.distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_class)
              .select("_id", "_h", "_y"))
    same = ["_id", "_h"]
    if not isinstance(classes, DataFrame):
        texts, same = texts.withColumn("_y", classes), ["_id", "_h", "_y"]
    return (texts.select("_t", *same).join(F.broadcast(picked), same).groupBy("_id", "_h", "_y")
            .agg(F.first("_t").alias("_t")).select("_id", "_t", "_y"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``per_class`` training rows of each label as (text, label).

    Bounds of the sample, both parameters: the ``per_class`` rows of each
    label that come first by a hash of their id, among the labelled rows that
    are not held out and have 1 to ``max_chars`` characters.  Rows of one id
    with both labels are left out; rows that share an id count one by one, a
    row that repeats counts once.  At most ``2 * per_class * max_chars``
    characters reach the driver, however large the tables are.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id"))
             .agg(F.min(label).alias("_y"), F.max(label).alias("_z"))
             .where("_y = _z").select("_id", "_y"))
    fit = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).where(
        F.length("_t").between(1, max_chars))
    rows = bounded_sample(fit, known, per_class, [F.xxhash64(F.lit(label), "_id")]).collect()
    return [(r["_t"], r["_y"]) for r in sorted(rows, key=lambda r: (r["_id"], r["_t"]))]


def fit_logistic(x, y, steps: int = 60, ridge: float = 1e-3):
    """Weights of a logistic regression by Newton steps (numpy, on the
    driver, over a bounded sample).  Both labels weigh as they occur."""
    import numpy as np

    x = np.column_stack([np.ones(len(x)), np.asarray(x, float).reshape(len(y), -1)])
    y, w = np.asarray(y, float), np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def map_columns(df: DataFrame, schema, start):
    """``df`` with columns computed in Python, Arrow batch by batch.

    ``start()`` runs once a task and returns ``f(batch) -> {name: values}``;
    columns of ``schema`` that it does not give are passed on untouched (so
    integers beside nulls keep all their digits).
    """
    from pyspark.sql.pandas.types import to_arrow_type

    types = [(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    def run(batches):
        import pyarrow as pa

        f = start()
        for batch in batches:
            made = f(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[n], t) if n in made else batch.column(batch.schema.get_field_index(n))
                 for n, t in types], names=[n for n, _ in types])

    return df.mapInArrow(run, schema)


def texts_of(batch, text_col: str) -> list[str]:
    """The batch's texts, null as empty."""
    return [t if t is not None else "" for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
