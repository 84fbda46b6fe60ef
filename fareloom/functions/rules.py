"""Row-quality rules: a rule is a name and a boolean column."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closed ranges a trip must lie in.
TRIP_RANGES = {
    "trip_distance": (0, 1000),
    "passenger_count": (1, 8),
    "fare_amount": (0, 1000),
    "total_amount": (0, 1000),
}


def trip_rules(
    pickup: str = "pickup_datetime",
    dropoff: str = "dropoff_datetime",
    origin: str = "PULocationID",
    destination: str = "DOLocationID",
    ranges: dict[str, tuple[float, float]] | None = None,
) -> dict[str, Column]:
    """The rules a trip must pass, by name."""
    ranges = TRIP_RANGES if ranges is None else ranges
    return (
        {f"{c}_present": F.col(c).isNotNull() for c in (pickup, dropoff)}
        | {"times_in_order": F.col(pickup) < F.col(dropoff)}
        | {f"{c}_in_range": F.col(c).between(low, high) for c, (low, high) in ranges.items()}
        | {f"{c}_present": F.col(c).isNotNull() for c in (origin, destination)}
        | {"places_differ": F.col(origin) != F.col(destination)}
    )


def keep_row(rules: dict[str, Column]) -> Column:
    """All rules hold. NULL, like false, rejects the row when used as a filter."""
    return reduce(and_, rules.values())


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that do not hold (false or NULL), in rule order."""
    return F.array_compact(
        F.array(*(F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()))
    )
