"""Scalar helpers: text maximum, time features, one-hot, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.fixed import LIGHT_HOUR_START, MEAN_FORMAT


def text_to_int(c: Column) -> Column:
    """Parse outside text as int; unparsable text is null (ANSI-safe)."""
    return F.trim(c).try_cast("int")


def weekday_monday0(ts: Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(ts)


def light_hour(ts: Column) -> Column:
    """Hour rotated so that 07:00 is 0: h-7 for h >= 7, else h+17."""
    h = F.hour(ts)
    return F.when(h >= LIGHT_HOUR_START, h - LIGHT_HOUR_START).otherwise(h + (24 - LIGHT_HOUR_START))


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, floored (1.5 s early gives -2)."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


def one_hot(c: Column, value) -> Column:
    """1 where ``c == value``, else 0 (null compares as 0)."""
    return F.coalesce((c == F.lit(value)).cast("int"), F.lit(0))


def format4(c: Column) -> Column:
    """Four-decimal text, as ``%.4f``."""
    return F.format_string(MEAN_FORMAT, c)
