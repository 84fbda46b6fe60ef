"""Joins, group aggregates, roll-ups and rankings."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareloom.operators import aggregates as A
from fareloom.operators.features import add_derived_features
from fareloom.operators.feeds import add_metadata_columns
from fareloom.operators.ratios import hit_rate, inside_circle
from fareloom.operators.text import top_words, word_count, words

ZONE_DDL = "LocationID int, Borough string, Zone string, service_zone string"


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "B1", "Z1", "s"), (2, "B1", "Z2", "s"), (3, "B2", "Z3", "s")], ZONE_DDL)


@pytest.fixture
def trips(trip):
    rows = [
        {"PULocationID": place, "trip_distance": float(i), "fare_amount": 10.0 * i, "total_amount": 10.0 * i + 2,
         "pickup_datetime": datetime(2025, 1, 1 + i, 6 + i), "dropoff_datetime": datetime(2025, 1, 1 + i, 7 + i)}
        for i, place in enumerate([1, 1, 1, 2, 3, 99, None])
    ]
    return add_metadata_columns(add_derived_features(trip(*rows)), "yellow")


def test_join_keeps_trips_without_a_zone(trips, zones):
    joined = A.join_pickup_zone(trips, zones)
    assert joined.count() == 7
    assert joined.filter("pickup_borough IS NULL").count() == 2


def test_zone_aggregate(trips, zones):
    rows = A.aggregate_by_zone(trips, zones).collect()
    assert [(r.PULocationID, r.pickup_zone, r.total_trips) for r in rows] == [
        (1, "Z1", 3), (None, None, 1), (2, "Z2", 1), (3, "Z3", 1), (99, None, 1),
    ]
    assert (rows[0].avg_trip_distance, rows[0].avg_fare_amount, rows[0].total_revenue) == (1.0, 10.0, 36.0)
    assert rows[0].avg_trip_duration == 60.0
    assert sum(r.total_trips for r in rows) == trips.count()


def test_zone_aggregate_columns(trips, zones):
    assert set(A.aggregate_by_zone(trips, zones).columns) == {
        "PULocationID", "pickup_borough", "pickup_zone", "total_trips", "avg_trip_distance", "avg_trip_duration",
        "avg_fare_amount", "avg_total_amount", "avg_tip_amount", "avg_tip_rate", "avg_passenger_count", "total_revenue",
    }


def test_aggregating_first_equals_joining_first_even_with_repeated_zones(spark, trips):
    zones = spark.createDataFrame(
        [(1, "B1", "Z1", "s"), (1, "B1", "Z1", "t"), (1, "B9", "Z9", "s"), (2, None, None, "s"), (None, "B0", "Z0", "s")],
        ZONE_DDL,
    )
    joined_first = (
        A.join_pickup_zone(trips, zones)
        .groupBy("PULocationID", "pickup_borough", "pickup_zone")
        .agg(F.count("*").alias("n"), F.avg("fare_amount").alias("fare"), F.sum("total_amount").alias("revenue"))
    )
    ours = A.zone_totals(trips, zones).select(
        "PULocationID", "pickup_borough", "pickup_zone", "total_trips", "avg_fare_amount", "total_revenue"
    )
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, map(tuple, joined_first.collect())))


def test_no_trip_passes_through_the_zone_join(trips, zones, plan):
    text = plan(A.zone_totals(trips, zones))
    assert text.index("Join") < text.index("HashAggregate")


def test_time_aggregate_is_in_calendar_order(trips):
    rows = A.aggregate_by_time(trips).collect()
    keys = [(r.pickup_year, r.pickup_month, r.pickup_hour, r.is_weekend) for r in rows]
    assert keys == sorted(keys)
    assert sum(r.total_trips for r in rows) == 7


def test_rollups_average_group_averages(spark):
    zone_rows = spark.createDataFrame(
        [("B1", 1, 10.0, 1.0), ("B1", 9, 20.0, 9.0), (None, 5, 30.0, 100.0)],
        "pickup_borough string, total_trips long, avg_fare_amount double, total_revenue double",
    )
    rows = A.borough_rollup(zone_rows, weighted=True).collect()
    assert [tuple(r) for r in rows] == [(None, 5, 100.0, 30.0, 30.0), ("B1", 10, 10.0, 15.0, 19.0)]


def test_hour_and_weekend_patterns(trips):
    time = A.time_totals(trips)
    hours = A.hourly_pattern(time).collect()
    assert [r.pickup_hour for r in hours] == [6, 7, 8, 9, 10, 11, 12]
    assert set(hours[0].asDict()) == {"pickup_hour", "total_trips", "avg_distance", "avg_fare"}
    weekend = {r.is_weekend: r.total_trips for r in A.weekend_pattern(time).collect()}
    assert weekend == {False: 5, True: 2}
    assert "avg_fare_weighted" in A.weekend_pattern(time, weighted=True).columns


def test_weighted_mean_of_groups_is_the_mean_of_rows(trips):
    row = A.weekend_pattern(A.time_totals(trips), weighted=True).agg(
        (F.sum(F.col("avg_fare_weighted") * F.col("total_trips")) / F.sum("total_trips")).alias("m")
    )
    assert abs(row.first().m - trips.agg(F.avg("fare_amount")).first()[0]) < 1e-9


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 9)], "id int, n int")
    assert [r.id for r in A.top_k(df, 2, "n", "id").collect()] == [2, 1]


def test_top_zones(trips, zones):
    rows = A.top_zones(A.zone_totals(trips, zones), k=1).collect()
    assert [(r.pickup_zone, r.total_trips) for r in rows] == [("Z1", 3)]


def test_top_k_is_a_bounded_sort(trips, zones, plan):
    assert "TakeOrderedAndProject" in plan(A.top_zones(A.zone_totals(trips, zones)))


def test_payment_analysis(trip):
    df = add_derived_features(trip({"tip_amount": 2.0}, {"tip_amount": None}, {})).withColumn("payment_type", F.lit(1))
    row = A.payment_analysis(df).first()
    assert (row.trip_count, row.avg_tip, row.avg_tip_rate) == (3, 3.0, 15.0)


def test_feed_figures(trips):
    both = trips.union(trips.withColumn("taxi_type", F.lit("green")))
    assert [tuple(r) for r in A.feed_distribution(both).collect()] == [("green", 7), ("yellow", 7)]
    assert {tuple(r) for r in A.revenue_by_feed(both).collect()} == {("green", 224.0), ("yellow", 224.0)}
    assert {r.revenue_per_trip for r in A.revenue_per_trip(both).collect()} == {32.0}
    assert {round(r.revenue_per_mile, 4) for r in A.distance_efficiency(both).collect()} == {10.6667}


def test_trips_per_active_hour(trip):
    start = datetime(2025, 1, 1, 10, 0)
    df = trip(*({"pickup_datetime": start + timedelta(minutes=m)} for m in (0, 30, 59, 60, 24 * 60)))
    row = A.trips_per_hour(df, by=()).first()
    assert tuple(row) == (5, 3, 5 / 3)


def test_kpis(trips):
    row = A.fleet_kpis(trips).first()
    assert (row.avg_trip_distance, row.avg_trip_duration, row.avg_passengers) == (3.0, 60.0, 1.0)
    assert abs(row.revenue_per_minute - 224 / 420) < 1e-12
    assert A.fleet_kpis(trips.limit(0)).first().revenue_per_minute is None


def test_revenue_shares_add_up_without_a_join(trips, plan):
    shares = A.revenue_share(trips)
    assert abs(sum(r.revenue_share for r in shares.collect()) - 1) < 1e-9
    text = plan(shares)
    assert "Join" not in text and "Cartesian" not in text


def test_pairs_and_months(trips):
    assert tuple(A.popular_pairs(trips, 1).first()) == (1, 2, 3)
    assert [tuple(r) for r in A.monthly_trend(A.time_totals(trips)).collect()] == [(2025, 1, 7, 224.0)]


def test_words_split_on_anything_but_ascii_word_characters(spark):
    df = spark.createDataFrame([("a b,a",), ("",), ("...",), ("café x_1",), (None,)], "value string")
    assert sorted(r.word for r in words(df).collect()) == ["a", "a", "b", "caf", "x_1"]
    assert [tuple(r) for r in word_count(df).collect()] == [("a", 2), ("b", 1), ("caf", 1), ("x_1", 1)]
    assert [tuple(r) for r in top_words(df, 2).collect()] == [("a", 2), ("b", 1)]


def test_hit_rate(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (None, 0.0)], "x double, y double")
    inside = inside_circle(F.col("x"), F.col("y"))
    assert tuple(hit_rate(df, inside, scale=4.0).first()) == (4, 2, 2.0)
    assert tuple(hit_rate(df.limit(0), inside).first()) == (0, 0, None)


def test_a_place_with_a_third_of_all_trips_joins_whole_without_broadcast(spark, zones, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        trips = spark.range(300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 400).cast("int")).alias("PULocationID"), "id"
        )
        joined = A.join_pickup_zone(trips, zones)
        assert "SortMergeJoin" in plan(joined)
        found = joined.groupBy("pickup_zone").count().collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    expected = {"Z1": 0, "Z2": 0, "Z3": 0, None: 0}
    for i in range(300_000):
        place = 1 if i % 3 == 0 else i % 400
        expected[{1: "Z1", 2: "Z2", 3: "Z3"}.get(place)] += 1
    assert {r.pickup_zone: r["count"] for r in found} == expected
