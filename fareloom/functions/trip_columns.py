"""Column expressions over trips. All compile to native Spark expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# First hour (inclusive) and last hour (exclusive) of each named part of the day.
DAY_PARTS = {"Morning": (6, 12), "Afternoon": (12, 18), "Evening": (18, 22)}
REST_OF_DAY = "Night"

# Spark numbers days from Sunday = 1 to Saturday = 7.
WEEKEND_DAYS = (1, 7)


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes in whole seconds; fractions of a second are cut off before subtracting."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def miles_per_hour(miles: Column, minutes: Column) -> Column:
    """Speed; 0 where the duration is not positive or not known."""
    return F.when(minutes > 0, miles / minutes * 60).otherwise(F.lit(0.0))


def time_period(hour: Column) -> Column:
    """Name of the part of the day; hours outside all parts, and NULL, count as night."""
    label = F.lit(REST_OF_DAY)
    for name, (first, end) in DAY_PARTS.items():
        label = F.when((hour >= first) & (hour < end), name).otherwise(label)
    return label


def is_weekend(day_of_week: Column) -> Column:
    """Whether a Spark day number falls on a weekend; NULL counts as no."""
    return F.coalesce(day_of_week.isin(*WEEKEND_DAYS), F.lit(False))


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; 0 where the whole is not positive or not known."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
