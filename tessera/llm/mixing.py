"""Mixing sources to target weights (DataFrame operations only).

Efraimidis-Spirakis sampling: each document gets the exponential key
``-ln(u) / w`` with ``u`` drawn from a hash of its id and ``w`` its quality
weight; documents of a source are taken in key order until their prefix sum
of words meets the source's budget.  Complete epochs come first: a source
whose target is 1.4 times its size is taken once whole, and the remaining 0.4
are selected by key.  The document that crosses the budget is cut to the
words that remain, so a source's taken words miss its target by less than one
word.

The prefix sum is taken in two levels, so that no source is sorted in one
task: keys are mapped to [0, 1) and cut into slices; slice totals are summed
first, then rows within a slice.  The map is the mean of ``1 - exp(-rate *
key)`` over the four ``RATES``.  The key of a weight-``w`` document is
exponential with rate ``w``, so with a rate between ``w / 2`` and ``w`` among
the four, a slice holds at most eight times ``slice_rows`` documents on
average, however the weights are distributed (``1 - exp(-key)`` alone would put
nearly all documents of low weight into the last slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import staged, text_or_empty

#: cyclic source weights, share of all words to mix and most epochs of a source
WEIGHTS, SHARE_NUM, SHARE_DEN, MAX_EPOCHS = (5, 2, 1), 3, 2, 2
SYMBOLS = "!#$%&*+<=>@^_|~"
#: rates of the map from keys to slices: within a factor of two of any weight from 0.1 to 1
RATES = (0.1, 0.2, 0.4, 0.8)


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weight(text_col: str) -> Column:
    """Between 0.1 and 1: one less four times the share of symbol characters."""
    t = text_or_empty(text_col)
    n = F.length(t)
    odd = n - F.length(F.translate(t, SYMBOLS, ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * odd / F.greatest(n, F.lit(1)))


def uniform(id_col: str, seed: str) -> Column:
    """Uniform in (0, 1) from 52 bits of an md5 of seed and id."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(
        F.col(id_col).cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def position(key: Column) -> Column:
    """The key's place in [0, 1], in key order: see the module's text."""
    return sum((-F.expm1(F.lit(-r) * key) for r in RATES[1:]), -F.expm1(F.lit(-RATES[0]) * key)) / F.lit(float(len(RATES)))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources: (_src, source_size, target).

    ``sizes`` has a row for each source (_src, source_size).  Weights follow
    the sources' code-point order, null last.  The capped shares are found in
    closed form: with the sources in order of cap / weight, the first one
    whose cap is at least its share of what the earlier ones leave fixes the
    level of all later ones.  One row for each source is sorted, no document.
    """
    names = Window.orderBy(F.col("_src").asc_nulls_last())
    cycle = F.create_map(*[F.lit(x) for i, w in enumerate(WEIGHTS) for x in (i, float(w))])
    s = sizes.select("*", cycle[(F.row_number().over(names) - 1) % len(WEIGHTS)].alias("_w"),
                     (F.col("source_size") * MAX_EPOCHS).alias("_cap"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.select("*", (
        (F.sum("source_size").over(every) * SHARE_NUM / SHARE_DEN
         - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(rest)).alias("_level"))
    fits = F.max(F.when(F.col("_cap") >= F.col("_level") * F.col("_w"), F.col("_level"))).over(every)
    return s.select("_src", "source_size", F.least(
        F.col("_cap").cast("double"), F.coalesce(fits * F.col("_w"), F.col("_cap").cast("double"))
    ).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, seed: str = "mix", slice_rows: int = 5_000) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, quality_weight.

    ``taken`` counts words with repeats and never exceeds ``MAX_EPOCHS``
    times the size.  Null text has size 0 and is never taken; a null source
    is a source of its own; a null id draws one key like any other.  Equal keys (repeated ids) are taken in order of
    size.  The same input gives the same result on every run.
    """
    d = staged(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_src"), word_count(text_col).alias("size"),
        (quality_weight(text_col) if weight is None else weight).cast("double").alias("_q"),
        uniform(id_col, seed).alias("_u")).select(
        "_id", "_src", "size", "_q", (-F.log("_u") / F.col("_q")).alias("_key")))

    src = d.groupBy("_src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    target = source_targets(src.select("_src", "source_size")).select(
        "_src", "target", F.least(F.lit(MAX_EPOCHS), F.floor(
            F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))).cast("long").alias("_epochs"))
    src = staged(src.alias("a").join(target.alias("b"), F.col("a._src").eqNullSafe(F.col("b._src")))
                 .select("a._src", "source_size", "target", "_epochs", F.ceil(
                     F.col("_rows") / F.lit(slice_rows)).cast("long").alias("_slices")))
    d = d.alias("d").join(src.alias("s"), F.col("d._src").eqNullSafe(F.col("s._src"))).select(
        "d.*", "source_size", "target", "_epochs",
        F.floor(position(F.col("_key")) * F.col("_slices")).cast("long").alias("_slice"))

    ahead = Window.partitionBy("_src").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (d.groupBy("_src", "_slice").agg(F.sum("size").alias("_n"))
              .select("_src", "_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead")))
    inside = (Window.partitionBy("_src", "_slice").orderBy("_key", F.col("_id").asc_nulls_last(), "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = d.alias("d").join(slices.alias("s"), F.col("d._src").eqNullSafe(F.col("s._src"))
                          & (F.col("d._slice") == F.col("s._slice"))).select("d.*", "_ahead")
    left = (F.floor(F.col("target")).cast("long") - F.col("_epochs") * F.col("source_size")
            - F.col("_ahead") - F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return d.select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("_epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
         ).cast("long").alias("taken"), F.col("_q").alias("quality_weight"))
