"""Derived columns at their boundaries."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fareloom.functions import is_weekend, miles_per_hour, minutes_between, percent_of, time_period
from fareloom.operators.features import add_derived_features


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "hour, name",
    [(0, "Night"), (5, "Night"), (6, "Morning"), (11, "Morning"), (12, "Afternoon"), (17, "Afternoon"),
     (18, "Evening"), (21, "Evening"), (22, "Night"), (23, "Night"), (None, "Night")],
)
def test_time_period(spark, hour, name):
    assert value(spark, time_period(F.lit(hour).cast("int"))) == name


@pytest.mark.parametrize(
    "day, weekend", [(1, True), (2, False), (6, False), (7, True), (None, False)]
)
def test_weekend(spark, day, weekend):
    assert value(spark, is_weekend(F.lit(day).cast("int"))) is weekend


@pytest.mark.parametrize(
    "miles, minutes, speed", [(10.0, 30.0, 20.0), (10.0, 0.0, 0.0), (10.0, -5.0, 0.0), (10.0, None, 0.0)]
)
def test_speed(spark, miles, minutes, speed):
    assert value(spark, miles_per_hour(F.lit(miles), F.lit(minutes).cast("double"))) == speed


@pytest.mark.parametrize(
    "tip, fare, rate", [(5.0, 20.0, 25.0), (5.0, 0.0, 0.0), (5.0, -1.0, 0.0), (5.0, None, 0.0), (None, 20.0, None)]
)
def test_tip_rate(spark, tip, fare, rate):
    assert value(spark, percent_of(F.lit(tip).cast("double"), F.lit(fare).cast("double"))) == rate


def test_minutes_ignore_fractions_of_a_second(spark):
    start, end = datetime(2025, 1, 1, 10, 0, 0, 900000), datetime(2025, 1, 1, 10, 1, 30, 100000)
    assert value(spark, minutes_between(F.lit(start), F.lit(end))) == 1.5


def test_features_of_a_saturday_trip(trip):
    saturday = {"pickup_datetime": datetime(2025, 3, 1, 18, 0), "dropoff_datetime": datetime(2025, 3, 1, 18, 15)}
    row = add_derived_features(trip(saturday)).first()
    assert row.trip_duration_minutes == 15.0
    assert row.average_speed_mph == 20.0
    assert (row.pickup_hour, row.pickup_day_of_week, row.pickup_month, row.pickup_year) == (18, 7, 3, 2025)
    assert (row.time_period, row.is_weekend, row.tip_rate) == ("Evening", True, 20.0)


def test_features_of_an_unknown_pickup(trip):
    row = add_derived_features(trip({"pickup_datetime": None})).first()
    assert row.trip_duration_minutes is None
    assert (row.average_speed_mph, row.time_period, row.is_weekend) == (0.0, "Night", False)


def test_feature_types(trip):
    types = dict(add_derived_features(trip({})).dtypes)
    assert types["trip_duration_minutes"] == types["average_speed_mph"] == types["tip_rate"] == "double"
    assert types["pickup_hour"] == types["pickup_day_of_week"] == "int"
    assert types["pickup_month"] == types["pickup_year"] == "int"
    assert (types["time_period"], types["is_weekend"]) == ("string", "boolean")


def test_local_clock_columns_give_the_same_features(trip):
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")}
    added = ["trip_duration_minutes", "pickup_hour", "time_period"]
    df = trip({})
    assert (
        add_derived_features(df.withColumns(ntz)).select(added).collect()
        == add_derived_features(df).select(added).collect()
    )
