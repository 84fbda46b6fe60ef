"""Derived trip columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.trip_columns import (
    is_weekend,
    miles_per_hour,
    minutes_between,
    percent_of,
    time_period,
)


def add_derived_features(
    df: DataFrame,
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
    distance: str = "trip_distance",
    fare: str = "fare_amount",
    tip: str = "tip_amount",
) -> DataFrame:
    """Append duration, speed, calendar parts, part of day, weekend flag and tip rate."""
    start, end = F.col(pickup), F.col(dropoff)
    minutes = minutes_between(start, end)
    return df.withColumns(
        {
            "trip_duration_minutes": minutes,
            "average_speed_mph": miles_per_hour(F.col(distance), minutes),
            "pickup_hour": F.hour(start),
            "pickup_day_of_week": F.dayofweek(start),
            "pickup_month": F.month(start),
            "pickup_year": F.year(start),
            "time_period": time_period(F.hour(start)),
            "is_weekend": is_weekend(F.dayofweek(start)),
            "tip_rate": percent_of(F.col(tip), F.col(fare)),
        }
    )
