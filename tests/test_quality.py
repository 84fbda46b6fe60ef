"""Profiles, reports and statistics."""

from datetime import datetime

from pyspark.sql import functions as F

from fareloom.operators.cleaning import drop_duplicates
from fareloom.operators.quality import (
    duplicate_profile,
    invalid_values,
    layer_reduction,
    null_profile,
    null_summary,
    quality_report,
    row_counts,
)
from fareloom.operators.statistics import (
    busiest,
    date_range,
    describe_numeric,
    summary_statistics,
    summary_totals,
    table_shape,
)


def small(spark):
    return spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (2, 3.0, None), (4, 5.0, "y")], "`a.b` int, c double, d string"
    )


def test_null_profile_lists_every_column(spark):
    profile = {r.column_name: (r.null_count, r.null_percentage) for r in null_profile(small(spark)).collect()}
    assert profile == {"a.b": (0, 0.0), "c": (2, 50.0), "d": (1, 25.0)}


def test_null_summary_lists_columns_with_nulls(spark):
    assert {r.column_name for r in null_summary(small(spark)).collect()} == {"c", "d"}


def test_null_profile_is_one_aggregate(spark, plan):
    text = plan(null_profile(small(spark)))
    assert text.count("HashAggregate") == 2


def test_null_profile_of_an_empty_table(spark):
    assert {tuple(r)[1:] for r in null_profile(small(spark).limit(0)).collect()} == {(0, 0.0)}


def test_duplicate_profile(spark):
    assert tuple(duplicate_profile(small(spark)).first()) == (4, 3, 1, 25.0)
    assert tuple(duplicate_profile(small(spark).limit(0)).first()) == (0, 0, 0, 0.0)


def test_duplicate_profile_ignores_load_columns(spark):
    df = small(spark).withColumn("source_file", F.monotonically_increasing_id().cast("string"))
    assert duplicate_profile(df).first().duplicate_count == 1
    assert duplicate_profile(df, ignore=()).first().duplicate_count == 0


def test_quality_report_agrees_with_the_profiles(spark):
    df = small(spark)
    report = {(r.scope, r.metric): r.value for r in quality_report(df).collect()}
    assert report[("table", "total_rows")] == 4
    assert report[("table", "total_columns")] == 3
    assert report[("table", "duplicate_count")] == 1
    assert report[("table", "duplicate_percentage")] == 25.0
    for row in null_profile(df).collect():
        assert report[(f"column:{row.column_name}", "null_count")] == row.null_count
        assert report[(f"column:{row.column_name}", "null_percentage")] == row.null_percentage


def test_quality_report_scans_once(spark, plan, tmp_path):
    small(spark).write.parquet(str(tmp_path / "t"))
    assert plan(quality_report(spark.read.parquet(str(tmp_path / "t")))).count("FileScan") == 1


def test_invalid_values_do_not_count_nulls(trip):
    at = datetime(2025, 1, 1, 10, 0)
    df = trip(
        {"trip_distance": -1.0}, {"fare_amount": -0.5}, {"total_amount": None}, {"passenger_count": 0},
        {"passenger_count": None}, {"pickup_datetime": at, "dropoff_datetime": at}, {"pickup_datetime": None},
    )
    assert dict(invalid_values(df).collect()) == {
        "negative_distance": 1, "negative_fare": 1, "negative_total": 0, "invalid_passengers": 1, "invalid_times": 1,
    }


def test_invalid_values_of_an_empty_table_are_zero(trip):
    assert {r.n_invalid for r in invalid_values(trip({}).limit(0)).collect()} == {0}


def test_layer_counts_and_reduction(spark):
    counts = row_counts(
        {("bronze", "x"): spark.range(8), ("silver", "x"): spark.range(6), ("gold", "all"): spark.range(6)}
    )
    assert {tuple(r) for r in counts.collect()} == {("bronze", "x", 8), ("silver", "x", 6), ("gold", "all", 6)}
    assert [tuple(r) for r in layer_reduction(counts).collect()] == [("x", 8, 6, 25.0)]


def test_describe_numeric_matches_describe(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    ours = describe_numeric(df, ["l_quantity", "l_linenumber"]).collect()
    theirs = {r["summary"]: r for r in df.select("l_quantity", "l_linenumber").describe().collect()}
    for row in ours:
        for metric, value in (("count", row.n), ("mean", row.mean), ("min", row.min), ("max", row.max)):
            assert float(theirs[metric][row.column_name]) == value
        assert abs(float(theirs["stddev"][row.column_name]) - row.stddev) < 1e-9


def test_summary_statistics(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (10.0, None)], "a double, b double")
    rows = {r.column_name: tuple(r)[1:] for r in summary_statistics(df, ["a", "b"]).collect()}
    mean, stddev, low, high, median = rows["a"]
    assert (mean, low, high, median) == (4.0, 1.0, 10.0, 2.0)
    assert abs(stddev - 4.0824829) < 1e-6
    assert rows["b"] == (0.0, 0.0, 0.0, 0.0, 0.0)
    approximate = {r.column_name: r.median for r in summary_statistics(df, ["a"], accuracy=100).collect()}
    assert approximate == {"a": 2.0}


def slots(spark, rows):
    return spark.createDataFrame(rows, "pickup_hour int, pickup_day_of_week int, total_amount double")


def test_summary_totals(spark):
    df = slots(spark, [(9, 2, 1.0), (9, 3, 2.0), (10, 3, 4.0), (10, 4, 8.0), (11, 3, None)])
    assert tuple(summary_totals(df, "all").first()) == ("all", 5, 15.0, 9, 3)


def test_summary_totals_of_an_empty_table(spark):
    assert tuple(summary_totals(slots(spark, [(1, 1, 1.0)]).limit(0), "none").first()) == ("none", 0, 0.0, None, None)


def test_busiest_breaks_ties_by_key(spark):
    df = slots(spark, [(9, 2, 1.0), (8, 3, 2.0), (9, 3, 4.0), (8, 4, 8.0)])
    assert tuple(busiest(df, "pickup_hour").first()) == (8, 2)
    assert busiest(df.limit(0), "pickup_hour").count() == 0


def test_date_range_and_shape(trip):
    df = trip({}, {"pickup_datetime": datetime(2024, 5, 1)}, {"pickup_datetime": None})
    row = date_range(df).first()
    assert (row.min_date, row.max_date, row.total_records) == (datetime(2024, 5, 1), datetime(2025, 1, 1, 10, 0), 3)
    assert tuple(table_shape(df).first()) == (3, 9)


def test_names_with_dots_and_backquotes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, None)], "`a.b` double, `c``d` double")
    assert drop_duplicates(df, ignore=("c`d",)).columns == ["a.b", "c`d"]
    assert [r.n for r in describe_numeric(df, df.columns).collect()] == [3, 2]
    assert [r.median for r in summary_statistics(df, df.columns).collect()] == [1.0, 2.0]
    assert quality_report(df).filter("metric = 'total_columns'").first().value == 2


def test_quality_report_covers_the_load_columns(spark):
    rows = [(1, "x", None), (1, "y", None), (2, None, "f")]
    df = spark.createDataFrame(rows, "k int, processed_timestamp string, source_file string")
    report = {(r.scope, r.metric): r.value for r in quality_report(df).collect()}
    assert report["table", "total_columns"] == 3 and report["table", "duplicate_count"] == 1
    assert report["column:processed_timestamp", "null_count"] == 1
    assert report["column:source_file", "null_count"] == 2
