"""Descriptive statistics of numeric columns, and table totals."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.names import quoted
from fareloom.operators.quantiles import quantiles_and_moments

# Columns described on the raw layer and summarised on the refined layer; the names
# of the statistics and totals below are fixed values as well.
DESCRIBED_COLUMNS = ("trip_distance", "fare_amount", "total_amount", "tip_amount", "passenger_count")
SUMMARY_COLUMNS = (
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "total_amount",
    "tip_amount",
    "passenger_count",
)


def describe_numeric(df: DataFrame, columns: Sequence[str] = DESCRIBED_COLUMNS) -> DataFrame:
    """Per column, as numbers: column_name, n, mean, stddev, min, max. One aggregate."""
    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(quoted(c)).alias("n"),
                F.avg(quoted(c)).alias("mean"),
                F.stddev_samp(quoted(c)).alias("stddev"),
                F.min(quoted(c)).cast("double").alias("min"),
                F.max(quoted(c)).cast("double").alias("max"),
            )
            for c in columns
        )
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def summary_statistics(
    df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS, accuracy: int | None = None
) -> DataFrame:
    """Per column: mean, sample stddev, min, max and median, 0 where there is no value.

    The median is exact; the first scan of its search that counts values also gives the other
    figures, which are computed right away. With ``accuracy`` it is an approximate one, all in one aggregate.
    """
    if accuracy is None:
        medians, moments = quantiles_and_moments(df, {c: (0.5,) for c in columns})
        rows = [
            (c, *(v or 0.0 for v in (m.mean, m.deviation(), m.smallest, m.largest, medians[c][0])))
            for c, m in moments.items()
        ]
        kind = "column_name string, mean double, stddev double, min double, max double, median double"
        return df.sparkSession.createDataFrame(rows, kind)
    median = {c: F.percentile_approx(quoted(c), 0.5, accuracy) for c in columns}

    def or_zero(value: Column, name: str) -> Column:
        return F.coalesce(value.cast("double"), F.lit(0.0)).alias(name)

    rows = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                or_zero(F.avg(quoted(c)), "mean"),
                or_zero(F.stddev_samp(quoted(c)), "stddev"),
                or_zero(F.min(quoted(c)), "min"),
                or_zero(F.max(quoted(c)), "max"),
                or_zero(median[c], "median"),
            )
            for c in columns
        )
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def summary_totals(df: DataFrame, taxi_type: str) -> DataFrame:
    """One row: taxi_type, total_trips, total_revenue, busiest_hour, busiest_day.

    One aggregate: counting per hour and per day takes 25 and 8 counters at the most. Ties go
    to the earlier hour or day; trips without one count as a value of their own.
    """

    def most_frequent(key: str) -> Column:
        unknown = F.lit(-1)
        return F.nullif(F.mode(F.coalesce(key, unknown), deterministic=True), unknown)

    return df.agg(
        F.lit(taxi_type).alias("taxi_type"),
        F.count(F.lit(1)).alias("total_trips"),
        F.coalesce(F.sum("total_amount"), F.lit(0.0)).alias("total_revenue"),
        most_frequent("pickup_hour").alias("busiest_hour"),
        most_frequent("pickup_day_of_week").alias("busiest_day"),
    )


def busiest(df: DataFrame, key: str) -> DataFrame:
    """The most frequent value of ``key`` and its count; the smaller value wins a tie."""
    return df.groupBy(key).count().orderBy(F.desc("count"), key).limit(1)


def date_range(df: DataFrame, column: str = "pickup_datetime", by: Sequence[str] = ()) -> DataFrame:
    """Earliest and latest ``column`` and the number of rows, per ``by`` or overall."""
    return df.groupBy(*by).agg(
        F.min(column).alias("min_date"),
        F.max(column).alias("max_date"),
        F.count(F.lit(1)).alias("total_records"),
    )


def table_shape(df: DataFrame) -> DataFrame:
    """One row: total_rows, total_columns."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.lit(len(df.columns)).alias("total_columns")
    )
