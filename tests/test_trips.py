import datetime as dt

import pytest

from tessera.plans import trips as T
from tessera.sources import delimited as D


def trip(pick, drop, pc=1, dist=1.0, coords=(1.0, 1.0, 1.0, 1.0), pay=1, tip=2.0, total=10.0):
    return (1, pick, drop, pc, dist, coords[0], coords[1], 1, "N", coords[2], coords[3], pay,
            8.0, 0.5, 0.5, tip, 0.0, 0.3, total)


def df(spark, rows):
    return spark.createDataFrame(rows, D.TRIPS)


def test_light_hour_rotation(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [trip(base.replace(hour=h), base.replace(hour=h) + dt.timedelta(seconds=5)) for h in (7, 23, 0, 6)]
    out = [r["lighthour"] for r in T.trip_features(df(spark, rows)).collect()]
    assert out == [0, 16, 17, 23]


def test_duration_floors(spark):
    p = dt.datetime(2024, 3, 4, 10, 0, 0, 500000)
    rows = [trip(p, p - dt.timedelta(seconds=1.5)), trip(p, p + dt.timedelta(seconds=1.5))]
    out = [r["duration"] for r in T.trip_features(df(spark, rows)).collect()]
    assert out == [-2, 1]


def test_filters_columns_and_one_hot(spark):
    p = dt.datetime(2024, 3, 4, 10)          # a Monday
    q = p + dt.timedelta(minutes=3)
    rows = [trip(p, q), trip(p, q, pay=2, tip=0.0), trip(p, q, coords=(0.0, 1.0, 1.0, 1.0)),
            trip(p, q, pc=0), trip(p, q, total=0.0), trip(p, q, dist=0.0), trip(None, q)]
    out = T.trip_features(df(spark, rows))
    assert out.columns == ["passenger_count", "trip_distance", "pickup_longitude", "pickup_latitude",
                           "dropoff_longitude", "dropoff_latitude", "payment_type", "tolls_amount",
                           "total_amount", "dayofweek", "lighthour", "duration", "credit_card", "cash"]
    got = [(r["dayofweek"], r["duration"], r["credit_card"], r["cash"]) for r in out.collect()]
    assert got == [(0, 180, 1, 0), (0, 180, 0, 1)]


def test_mean_card_tip(spark):
    p = dt.datetime(2024, 3, 4, 10)
    q = p + dt.timedelta(minutes=3)
    rows = [trip(p, q, tip=2.0), trip(p, q, tip=0.0), trip(p, q, tip=4.0), trip(p, q, pay=2, tip=9.0)]
    assert T.mean_card_tip(df(spark, rows)).first()[0] == pytest.approx(3.0)


def test_missing_filter_column_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        T.clean_trips(spark.createDataFrame([(1,)], "passenger_count int"))
