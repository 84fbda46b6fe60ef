from fareloom.functions.rules import failed_rules, keep_row, trip_rules
from fareloom.functions.trip_columns import (
    is_weekend,
    miles_per_hour,
    minutes_between,
    percent_of,
    time_period,
)

__all__ = [
    "failed_rules",
    "is_weekend",
    "keep_row",
    "miles_per_hour",
    "minutes_between",
    "percent_of",
    "time_period",
    "trip_rules",
]
