"""Data-quality reports. Each is a small table from one aggregate; copies are counted ahead of it."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.names import quoted
from fareloom.functions.trip_columns import percent_of
from fareloom.operators.copies import count_copies
from fareloom.sources.schemas import LOAD_COLUMNS


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: column_name, null_count, null_percentage. One aggregate over the input."""
    total = F.count(F.lit(1))
    profile = df.agg(
        F.array(
            *(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count_if(quoted(c).isNull()).alias("null_count"),
                    percent_of(F.count_if(quoted(c).isNull()), total).alias("null_percentage"),
                )
                for c in df.columns
            )
        ).alias("profile")
    )
    return profile.select(F.inline("profile"))


def null_summary(df: DataFrame) -> DataFrame:
    """The null profile, only for columns that have NULLs."""
    return null_profile(df).filter("null_count > 0")


def _compared(df: DataFrame, ignore: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in ignore]


def duplicate_profile(df: DataFrame, ignore: Sequence[str] = LOAD_COLUMNS) -> DataFrame:
    """One row: total_rows, distinct_rows, duplicate_count, duplicate_percentage.

    Rows are compared whole, but for the columns to ``ignore``. Copies are counted right
    away, by hash first, so that unique rows are not moved.
    """
    duplicates = F.lit(count_copies(df, _compared(df, ignore))).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        (F.col("total_rows") - duplicates).alias("distinct_rows"),
        duplicates.alias("duplicate_count"),
        percent_of(duplicates, F.col("total_rows")).alias("duplicate_percentage"),
    )


def quality_report(df: DataFrame, ignore: Sequence[str] = LOAD_COLUMNS) -> DataFrame:
    """Row, column, duplicate and NULL figures in one table: scope, metric, value.

    ``scope`` is ``table`` or ``column:<name>``. Copies are counted right away, by hash first;
    rows and NULLs are counted in one partial aggregate, which moves a row per task. Columns to
    ``ignore`` are left out of the comparison only.
    """
    total = F.count(F.lit(1))
    duplicates = F.lit(count_copies(df, _compared(df, ignore)))

    def row(scope: str, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(scope).alias("scope"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
        )

    rows = [
        row("table", "total_rows", total),
        row("table", "total_columns", F.lit(len(df.columns))),
        row("table", "duplicate_count", duplicates),
        row("table", "duplicate_percentage", percent_of(duplicates, total)),
    ]
    for c in df.columns:
        nulls = F.count_if(quoted(c).isNull())
        rows += [
            row(f"column:{c}", "null_count", nulls),
            row(f"column:{c}", "null_percentage", percent_of(nulls, total)),
        ]
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def trip_checks() -> dict[str, Column]:
    """Conditions under which a raw trip is reported as invalid, by name."""
    # The reported checks and their limits.
    return {
        "negative_distance": F.col("trip_distance") < 0,
        "negative_fare": F.col("fare_amount") < 0,
        "negative_total": F.col("total_amount") < 0,
        "invalid_passengers": F.col("passenger_count") <= 0,
        "invalid_times": F.col("pickup_datetime") >= F.col("dropoff_datetime"),
    }


def invalid_values(df: DataFrame, checks: Mapping[str, Column] | None = None) -> DataFrame:
    """Per check: check, n_invalid. A condition that is NULL does not count as invalid."""
    checks = checks or trip_checks()
    counts = df.agg(*(F.count_if(condition).alias(name) for name, condition in checks.items()))
    return counts.unpivot([], list(checks), "check", "n_invalid")


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows of each stored table: layer, table_name, n_rows. Counts come from file metadata."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows"
            )
            for (layer, name), df in tables.items()
        ),
    )


def layer_reduction(counts: DataFrame, before: str = "bronze", after: str = "silver") -> DataFrame:
    """Per table present in both layers: rows before, rows after, percent removed."""

    def rows(layer: str) -> Column:
        return F.sum(F.when(F.col("layer") == layer, F.col("n_rows")))

    reduction = counts.groupBy("table_name").agg(
        rows(before).alias("rows_before"), rows(after).alias("rows_after")
    )
    return reduction.filter("rows_before IS NOT NULL AND rows_after IS NOT NULL").withColumn(
        "pct_removed", percent_of(F.col("rows_before") - F.col("rows_after"), F.col("rows_before"))
    )
