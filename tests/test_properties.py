"""Cleaning, features and aggregates of random trips against plain Python."""

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from conftest import TRIP_DDL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareloom.operators.aggregates import time_totals, zone_totals
from fareloom.operators.cleaning import clean_trips, drop_duplicates, rejected_trips
from fareloom.operators.features import add_derived_features
from fareloom.operators.quality import duplicate_profile, null_profile

START = datetime(2025, 1, 1)
money = st.one_of(st.none(), st.sampled_from([-0.5, 0.0, 10.0, 1000.0, 1000.5]))
moment = st.one_of(st.none(), st.integers(0, 20_000).map(lambda m: START + timedelta(minutes=m)))
place = st.one_of(st.none(), st.integers(1, 4))
trips = st.lists(
    st.tuples(moment, moment, st.one_of(st.none(), st.integers(-1, 10)), money, money, money, money, place, place),
    min_size=1,
    max_size=40,
)
slow = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def passes(row):
    pickup, dropoff, passengers, distance, fare, total, _, origin, destination = row
    if None in (pickup, dropoff, passengers, distance, fare, total, origin, destination):
        return False
    return (
        pickup < dropoff
        and 1 <= passengers <= 8
        and all(0 <= v <= 1000 for v in (distance, fare, total))
        and origin != destination
    )


def table(spark, rows):
    return spark.createDataFrame(rows, TRIP_DDL)


@slow
@given(rows=trips)
def test_cleaning(spark, rows):
    df = table(spark, rows)
    assert Counter(map(tuple, clean_trips(df).collect())) == Counter(r for r in rows if passes(r))
    rejected = rejected_trips(df).drop("failed_rules").collect()
    assert Counter(map(tuple, rejected)) == Counter(r for r in rows if not passes(r))


@slow
@given(rows=trips)
def test_duplicates_and_nulls(spark, rows):
    rows = rows + rows[: len(rows) // 3]
    df = table(spark, rows)
    assert Counter(map(tuple, drop_duplicates(df).collect())) == Counter(set(rows))
    profile = duplicate_profile(df).first()
    assert (profile.total_rows, profile.distinct_rows) == (len(rows), len(set(rows)))
    nulls = {r.column_name: r.null_count for r in null_profile(df).collect()}
    assert list(nulls.values()) == [sum(r[i] is None for r in rows) for i in range(len(rows[0]))]


@slow
@given(rows=trips)
def test_features_and_totals(spark, rows):
    df = add_derived_features(table(spark, rows))
    for row in df.collect():
        if row.pickup_datetime is not None:
            assert row.pickup_hour == row.pickup_datetime.hour
            assert row.pickup_day_of_week == row.pickup_datetime.isoweekday() % 7 + 1
            assert row.is_weekend == (row.pickup_datetime.weekday() >= 5)
        if row.pickup_datetime is not None and row.dropoff_datetime is not None:
            minutes = (row.dropoff_datetime - row.pickup_datetime).total_seconds() / 60
            assert row.trip_duration_minutes == minutes
            if row.trip_distance is not None:
                assert row.average_speed_mph == (row.trip_distance / minutes * 60 if minutes > 0 else 0)

    zones = spark.createDataFrame([(1, "B", "Z", "s")], "LocationID int, Borough string, Zone string, service_zone string")
    by_place = {r.PULocationID: (r.total_trips, r.avg_fare_amount) for r in zone_totals(df, zones).collect()}
    fares = defaultdict(list)
    for row in rows:
        fares[row[7]].append(row[4])
    for origin, values in fares.items():
        known = [v for v in values if v is not None]
        count, mean = by_place[origin]
        assert count == len(values)
        assert (mean is None and not known) or abs(mean - sum(known) / len(known)) < 1e-9
    assert sum(r.total_trips for r in time_totals(df).collect()) == len(rows)
