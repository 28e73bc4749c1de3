"""Trip feature preparation and the mean card tip.

One narrow stage: no shuffle until the single-row tip aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed import CARD_PAYMENT, CASH_PAYMENT, DROPPED_COLUMNS, NONZERO_COLUMNS
from tessera.functions.scalar import duration_seconds, light_hour, one_hot, weekday_monday0


def clean_trips(trips: DataFrame, nonzero: Sequence[str] = NONZERO_COLUMNS) -> DataFrame:
    """Rows with no null in any column and no zero in the ``nonzero`` columns,
    all of which must be there."""
    missing = [c for c in nonzero if c not in trips.columns]
    if missing:
        raise ValueError(f"trip columns are missing: {missing}")
    cond = reduce(lambda a, c: a & (F.col(c) != 0), nonzero, F.lit(True))
    return trips.na.drop("any").where(cond)


def trip_features(trips: DataFrame, nonzero: Sequence[str] = NONZERO_COLUMNS) -> DataFrame:
    """Kept columns plus dayofweek (Monday 0), lighthour (07:00 = 0),
    duration (floored seconds), credit_card and cash one-hot."""
    df = clean_trips(trips, nonzero)
    pick, drop = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    df = (df.withColumn("dayofweek", weekday_monday0(pick))
          .withColumn("lighthour", light_hour(pick))
          .withColumn("duration", duration_seconds(pick, drop))
          .withColumn("credit_card", one_hot(F.col("payment_type"), CARD_PAYMENT))
          .withColumn("cash", one_hot(F.col("payment_type"), CASH_PAYMENT)))
    return df.drop(*[c for c in DROPPED_COLUMNS if c in df.columns])


def mean_card_tip(trips: DataFrame, nonzero: Sequence[str] = NONZERO_COLUMNS) -> DataFrame:
    """All card tips divided by the number of card trips with a nonzero tip
    (currency per tipped card trip), over the cleaned rows; null when no card
    trip is tipped."""
    df = clean_trips(trips, nonzero)
    card = F.col("payment_type") == CARD_PAYMENT
    return df.agg(F.try_divide(F.sum(F.when(card, F.col("tip_amount"))).cast("double"),
                               F.count(F.when(card & (F.col("tip_amount") != 0), F.lit(1))).cast("double"))
                  .alias("mean_card_tip"))
