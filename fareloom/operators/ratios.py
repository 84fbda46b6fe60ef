"""Share of rows that meet a condition."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hit_rate(df: DataFrame, condition: Column, scale: float = 1.0) -> DataFrame:
    """One row: n_rows, n_hits and n_hits / n_rows times ``scale`` as ``estimate``.

    A condition that is NULL is not a hit; without rows the estimate is NULL.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(condition).alias("n_hits"))
    return counts.withColumn(
        "estimate", F.try_divide(F.lit(scale) * F.col("n_hits"), F.col("n_rows"))
    )


def inside_circle(x: Column, y: Column, radius_squared: float = 1.0) -> Column:
    """Whether the point lies in the circle around the origin."""
    return x * x + y * y <= radius_squared
