"""Join helpers: broadcast only behind a measured size bound.

``checked_broadcast`` first adds up the sizes of the scans the candidate side
reads (file sizes, known without running anything).  Above ``max_input_bytes``,
or where they are not known, it does not measure at all and hints a shuffle
join.  A plain projection or filter of scans that are below an eighth of
``max_bytes`` (a safe margin for compression) is broadcast without running a
job.  Otherwise it measures the side with one bounded pass (``limit(max_rows + 1)``; with small inputs the
limit's single-partition exchange is small too) and hints ``broadcast`` only
when both the row count and the byte size are proven under the caps.  A side
that fails gets a shuffle-join hint, so an estimate can never turn a large
side into a broadcast; AQE may still split skewed partitions of that join.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 << 20
DEFAULT_MAX_INPUT_BYTES = 1 << 30

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}


def _field_bytes(name: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    for cls, width in _FIXED_WIDTH.items():
        if isinstance(dtype, cls):
            return F.lit(8 + width)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.lit(8) + F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(dtype, T.ArrayType):
        return F.lit(16) + F.coalesce(F.size(col), F.lit(0)) * F.lit(16)
    # anything else: charge its JSON text length, an over-estimate
    return F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))


def measured_size(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> tuple[int, int]:
    """(rows, bytes) of ``df``, reading at most ``max_rows + 1`` rows."""
    row_bytes = reduce(lambda a, b: a + b,
                       [_field_bytes(f.name, f.dataType) for f in df.schema.fields],
                       F.lit(16))
    probe = (df.select(row_bytes.alias("b")).limit(max_rows + 1)
             .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("bytes")).first())
    return int(probe["n"]), int(probe["bytes"] or 0)


def input_bytes(df: DataFrame) -> int:
    """Sum of the size statistics of the leaves (scans) of the plan; where
    they cannot be read, more than any bound."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:  # plan statistics not reachable from this client
        return 1 << 62


def _widens_nothing(df: DataFrame) -> bool:
    """Whether the plan only projects and filters scans."""
    try:
        text = str(df._jdf.queryExecution().optimizedPlan().toString())
    except Exception:  # plan not reachable from this client
        return False
    return all(re.match(r"[\s:+-]*(Project|Filter|Relation)\b", line) for line in text.splitlines() if line.strip())


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES,
                      max_input_bytes: int = DEFAULT_MAX_INPUT_BYTES) -> DataFrame:
    """``broadcast(df)`` if it is proven small, else ``df`` hinted to shuffle."""
    scanned = input_bytes(df)
    if scanned > max_input_bytes:
        return df.hint("shuffle_merge")
    if scanned <= max_bytes // 8 and _widens_nothing(df):
        return F.broadcast(df)
    rows, size = measured_size(df, max_rows)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df)
    return df.hint("shuffle_merge")
