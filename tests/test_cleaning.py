"""Rules at their limits, audits, rejects and duplicates."""

import pytest
from pyspark.sql import functions as F

from fareloom.functions import trip_rules
from fareloom.operators.cleaning import (
    clean_trips,
    cleaning_audit,
    drop_duplicates,
    rejected_trips,
    rule_failures,
)
from fareloom.operators.copies import count_copies, split_copies
from fareloom.operators.feeds import add_metadata_columns
from fareloom.sources.schemas import LOAD_COLUMNS

LIMITS = {"trip_distance": (0.0, 1000.0), "fare_amount": (0.0, 1000.0), "total_amount": (0.0, 1000.0)}


@pytest.mark.parametrize("column", LIMITS)
def test_ranges_are_closed(trip, column):
    low, high = LIMITS[column]
    assert clean_trips(trip({column: low}, {column: high})).count() == 2
    outside = [low - 0.01, high + 0.01, None, float("nan"), float("inf")]
    assert clean_trips(trip(*({column: v} for v in outside))).count() == 0


def test_passengers_between_one_and_eight(trip):
    kept = clean_trips(trip(*({"passenger_count": n} for n in (None, -1, 0, 1, 8, 9))))
    assert [r.passenger_count for r in kept.collect()] == [1, 8]


def test_times_must_be_known_and_in_order(trip):
    at = trip({}).first().pickup_datetime
    bad = trip(
        {"dropoff_datetime": at},
        {"pickup_datetime": None},
        {"dropoff_datetime": None},
        {"pickup_datetime": trip({}).first().dropoff_datetime, "dropoff_datetime": at},
    )
    assert clean_trips(bad).count() == 0


def test_places_must_be_known_and_differ(trip):
    bad = trip({"PULocationID": None}, {"DOLocationID": None}, {"PULocationID": 2})
    assert clean_trips(bad).count() == 0


def test_cleaning_twice_changes_nothing(trip):
    once = clean_trips(trip({}, {"fare_amount": -1.0}, {"passenger_count": None}))
    assert clean_trips(once).collect() == once.collect()


def test_kept_and_rejected_are_all_rows(trip):
    df = trip({}, {}, {"fare_amount": -1.0}, {"passenger_count": None}, {"PULocationID": None})
    assert clean_trips(df).count() + rejected_trips(df).count() == df.count()


def test_rejects_name_every_failed_rule(trip):
    rejected = rejected_trips(trip({"fare_amount": -1.0, "PULocationID": None})).first()
    assert rejected.failed_rules == ["fare_amount_in_range", "PULocationID_present", "places_differ"]


def test_audit(trip):
    row = cleaning_audit(trip({}, {}, {}, {"fare_amount": None})).first()
    assert tuple(row) == (4, 3, 1, 25.0)


def test_audit_of_an_empty_table(trip):
    assert tuple(cleaning_audit(trip({}).limit(0)).first()) == (0, 0, 0, 0.0)


def test_rule_failures_count_rows_per_rule(trip):
    failures = dict(rule_failures(trip({}, {"PULocationID": None}, {"PULocationID": 2})).collect())
    assert failures["PULocationID_present"] == 1
    assert failures["places_differ"] == 2
    assert failures["fare_amount_in_range"] == 0
    assert list(failures) == list(trip_rules())


def test_other_columns_and_ranges(trip):
    rules = trip_rules(ranges={"tip_amount": (0, 3)})
    assert clean_trips(trip({}, {"tip_amount": 3.0}), rules).count() == 1


def test_duplicates_ignore_when_they_were_loaded(spark, trip):
    first = add_metadata_columns(trip({}, {}, {"fare_amount": 1.0}), "yellow", "a.parquet")
    later = first.withColumn("processed_timestamp", F.expr("processed_timestamp + interval 1 day"))
    distinct = drop_duplicates(first.union(later))
    assert distinct.columns == first.columns
    assert distinct.count() == 2
    earliest = first.agg(F.min("processed_timestamp")).first()[0].date()
    assert {r.processed_timestamp.date() for r in distinct.collect()} == {earliest}


def test_duplicates_treat_nulls_as_equal(trip):
    assert drop_duplicates(trip({"tip_amount": None}, {"tip_amount": None})).count() == 1


def test_dropping_duplicates_twice_changes_nothing(trip):
    once = drop_duplicates(trip({}, {}, {"fare_amount": 1.0}))
    assert sorted(drop_duplicates(once).collect()) == sorted(once.collect())


def loaded_twice(spark, trip, path, n=40):
    """Trips of which a tenth occur again, in a second file and load."""
    first = add_metadata_columns(trip(*({"fare_amount": float(k)} for k in range(n))), "yellow", F.lit("b.parquet"))
    again = first.where("fare_amount % 10 = 3").withColumn("source_file", F.lit("a.parquet"))
    first.unionByName(again).write.parquet(path)
    return spark.read.parquet(path)


def test_with_a_source_file_nothing_is_sorted_and_rules_reach_the_scan(spark, trip, plan, tmp_path):
    trips = loaded_twice(spark, trip, str(tmp_path / "trips"))
    text = plan(clean_trips(drop_duplicates(trips)))
    assert "Sort" not in text and text.count("HashAggregate") == 2
    assert text.count("GreaterThanOrEqual(fare_amount,0.0)") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_unique_rows_are_not_moved(spark, trip, plan, tmp_path):
    trips = loaded_twice(spark, trip, str(tmp_path / "trips"))
    kept = drop_duplicates(trips)
    assert kept.count() == 40
    copies = {r.fare_amount: r.source_file for r in kept.collect()}
    assert {f for f, name in copies.items() if name == "a.parquet"} == {3.0, 13.0, 23.0, 33.0}
    once, again = split_copies(trips, [c for c in trips.columns if c not in LOAD_COLUMNS])
    assert (once.count(), again.count()) == (36, 8) and "Exchange hashpartitioning" not in plan(once)
    unique = trips.where("source_file = 'b.parquet'")
    assert "Exchange" not in plan(drop_duplicates(unique)) and drop_duplicates(unique).count() == 40


def test_any_number_of_repeated_hashes_and_loads_gives_the_same_rows(spark, trip, tmp_path):
    trips = loaded_twice(spark, trip, str(tmp_path / "trips"))
    want = sorted(map(str, drop_duplicates(trips).collect()))
    for most in (0, 3, 4):
        assert sorted(map(str, drop_duplicates(trips, most=most).collect())) == want


def test_rows_that_share_a_hash_are_compared_whole(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None), (0, 0)], "a int, b int")
    once, again = split_copies(df, df.columns)
    assert once.count() == 1 and again.count() == 3
    assert sorted(map(tuple, drop_duplicates(df).collect()), key=str) == sorted([(1, None), (None, 1), (0, 0)], key=str)
    assert count_copies(df, df.columns) == 1


def test_equal_numbers_of_other_forms_and_maps_are_copies(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "a double")
    assert drop_duplicates(df).count() == 2 and count_copies(df, ["a"]) == 2
    nested = spark.sql("SELECT 1 AS a, array(map('k', 1)) AS b")
    assert split_copies(nested, ["a", "b"])[0].count() == 1


def test_a_row_repeated_very_often_and_an_empty_table(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE -1 END AS a", "CAST(id AS string) AS source_file")
    kept = drop_duplicates(df)
    assert kept.count() == 6668 and kept.where("a = -1").first().source_file == "1"
    assert drop_duplicates(df.limit(0)).count() == 0 and count_copies(df.limit(0), ["a"]) == 0
