"""Joins, group aggregates and rankings over refined trips."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output names of the averaged trip columns, in the order of the result. The names of
# counts, sums and keys in the aggregates below are fixed values as well.
TIME_AVERAGES = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration": "trip_duration_minutes",
    "avg_fare_amount": "fare_amount",
    "avg_total_amount": "total_amount",
    "avg_passenger_count": "passenger_count",
}
ZONE_AVERAGES = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration": "trip_duration_minutes",
    "avg_fare_amount": "fare_amount",
    "avg_total_amount": "total_amount",
    "avg_tip_amount": "tip_amount",
    "avg_tip_rate": "tip_rate",
    "avg_passenger_count": "passenger_count",
}
KPI_AVERAGES = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration": "trip_duration_minutes",
    "avg_speed": "average_speed_mph",
    "avg_passengers": "passenger_count",
    "avg_fare": "fare_amount",
    "avg_tip_rate": "tip_rate",
}

# Grouping columns of the time aggregate.
TIME_KEYS = ("pickup_year", "pickup_month", "pickup_hour", "time_period", "is_weekend")


def _averages(columns: dict[str, str]) -> list[Column]:
    return [F.avg(source).alias(name) for name, source in columns.items()]


def _trips() -> Column:
    return F.count(F.lit(1))


def pickup_zones(zones: DataFrame) -> DataFrame:
    """The zone lookup under the names it has next to a trip's pickup."""
    return zones.select(
        F.col("LocationID").alias("PULocationID"),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
    )


def join_pickup_zone(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Every trip with the borough and zone of its pickup, NULL where the lookup has none.

    No broadcast is forced: Spark broadcasts the lookup if its size is below the session's
    threshold, and otherwise joins by shuffle with skewed pickup places split.
    """
    return df.join(pickup_zones(zones), "PULocationID", "left")


def zone_totals(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, revenue and averages per pickup place, with its borough and zone; unsorted.

    Trips are aggregated on the bare id and the few resulting rows meet the lookup, so no
    trip passes through a join. A lookup that lists a place several times gives the
    result a join ahead of the grouping would give: one group per distinct
    borough and zone, its totals counted once per listing.
    """
    by_place = df.groupBy("PULocationID").agg(
        _trips().alias("total_trips"),
        *_averages(ZONE_AVERAGES),
        F.sum("total_amount").alias("total_revenue"),
    )
    listings = (
        pickup_zones(zones)
        .groupBy("PULocationID", "pickup_borough", "pickup_zone")
        .agg(F.count(F.lit(1)).alias("listed"))
    )
    times = F.coalesce(F.col("listed"), F.lit(1))
    return by_place.join(listings, "PULocationID", "left").select(
        "PULocationID",
        "pickup_borough",
        "pickup_zone",
        (F.col("total_trips") * times).alias("total_trips"),
        *ZONE_AVERAGES,
        (F.col("total_revenue") * times).alias("total_revenue"),
    )


def aggregate_by_zone(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone totals, busiest first."""
    return zone_totals(df, zones).orderBy(F.desc("total_trips"), "PULocationID")


def time_totals(df: DataFrame) -> DataFrame:
    """Trips, revenue and averages per year, month, hour, part of day and weekend flag; unsorted."""
    return df.groupBy(*TIME_KEYS).agg(
        _trips().alias("total_trips"),
        *_averages(TIME_AVERAGES),
        F.sum("total_amount").alias("total_revenue"),
    )


def aggregate_by_time(df: DataFrame) -> DataFrame:
    """Time totals in calendar order."""
    return time_totals(df).orderBy("pickup_year", "pickup_month", "pickup_hour", "is_weekend")


def _rolled_up(columns: dict[str, str], weighted: bool) -> list[Column]:
    """Means of group means; with ``weighted`` also means weighted by trips."""
    trips = F.col("total_trips")
    measures = _averages(columns)
    if weighted:
        measures += [
            F.try_divide(
                F.sum(F.col(source) * trips), F.sum(F.when(F.col(source).isNotNull(), trips))
            ).alias(f"{name}_weighted")
            for name, source in columns.items()
        ]
    return measures


def borough_rollup(zone_aggregate: DataFrame, weighted: bool = False) -> DataFrame:
    """Trips, revenue and the mean of the zones' mean fares per borough, by revenue."""
    return (
        zone_aggregate.groupBy("pickup_borough")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
            *_rolled_up({"avg_fare_amount": "avg_fare_amount"}, weighted),
        )
        .orderBy(F.desc("total_revenue"), "pickup_borough")
    )


def hourly_pattern(time_aggregate: DataFrame, weighted: bool = False) -> DataFrame:
    """Trips and means of the groups' means per hour of day."""
    columns = {"avg_distance": "avg_trip_distance", "avg_fare": "avg_fare_amount"}
    return (
        time_aggregate.groupBy("pickup_hour")
        .agg(F.sum("total_trips").alias("total_trips"), *_rolled_up(columns, weighted))
        .orderBy("pickup_hour")
    )


def weekend_pattern(time_aggregate: DataFrame, weighted: bool = False) -> DataFrame:
    """Trips and means of the groups' means for weekends and weekdays."""
    columns = {
        "avg_distance": "avg_trip_distance",
        "avg_duration": "avg_trip_duration",
        "avg_fare": "avg_fare_amount",
    }
    return time_aggregate.groupBy("is_weekend").agg(
        F.sum("total_trips").alias("total_trips"), *_rolled_up(columns, weighted)
    )


def top_k(df: DataFrame, k: int, measure: str, *tie_break: str) -> DataFrame:
    """The ``k`` rows with the largest ``measure``; ties go by the ``tie_break`` columns."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def top_zones(zone_aggregate: DataFrame, k: int = 10) -> DataFrame:
    """The zones with the most trips."""
    return top_k(zone_aggregate, k, "total_trips", "PULocationID").select(
        "pickup_borough",
        "pickup_zone",
        "total_trips",
        "avg_trip_distance",
        "avg_fare_amount",
        "total_revenue",
    )


def payment_analysis(df: DataFrame) -> DataFrame:
    """Trips, mean tip and mean tip rate per payment type, most used first."""
    return (
        df.groupBy("payment_type")
        .agg(
            _trips().alias("trip_count"),
            F.avg("tip_amount").alias("avg_tip"),
            F.avg("tip_rate").alias("avg_tip_rate"),
        )
        .orderBy(F.desc("trip_count"), "payment_type")
    )


def feed_distribution(df: DataFrame) -> DataFrame:
    """Trips per feed."""
    return df.groupBy("taxi_type").count().orderBy("taxi_type")


def fleet_kpis(df: DataFrame) -> DataFrame:
    """One row of fleet-wide means, and revenue per minute driven (NULL without minutes)."""
    return df.agg(
        *_averages(KPI_AVERAGES),
        F.try_divide(F.sum("total_amount"), F.sum("trip_duration_minutes")).alias(
            "revenue_per_minute"
        ),
    )


def trip_pairs(df: DataFrame) -> DataFrame:
    """Trips per pair of pickup and dropoff place; unsorted."""
    return df.groupBy("PULocationID", "DOLocationID").agg(_trips().alias("total_trips"))


def popular_pairs(df: DataFrame, k: int = 10) -> DataFrame:
    """The pairs of places with the most trips."""
    return top_k(trip_pairs(df), k, "total_trips", "PULocationID", "DOLocationID")


def revenue_by_feed(df: DataFrame) -> DataFrame:
    """Revenue per feed."""
    return df.groupBy("taxi_type").agg(F.sum("total_amount").alias("total_revenue"))


def trips_per_hour(df: DataFrame, by: Sequence[str] = ("taxi_type",)) -> DataFrame:
    """Trips per clock hour that had any, with the number of such hours.

    Rows are combined per clock hour first, so hours are counted without carrying a
    distinct set.
    """
    hours = df.groupBy(
        *by, F.to_date("pickup_datetime").alias("day"), F.hour("pickup_datetime").alias("hour")
    ).agg(_trips().alias("trips"))
    return hours.groupBy(*by).agg(
        F.sum("trips").alias("total_trips"),
        F.count("day").alias("active_hours"),
        F.try_divide(F.sum("trips"), F.count("day")).alias("trips_per_hour"),
    )


def revenue_per_trip(df: DataFrame, by: Sequence[str] = ("taxi_type",)) -> DataFrame:
    """Revenue divided by trips."""
    return df.groupBy(*by).agg(
        F.try_divide(F.sum("total_amount"), _trips()).alias("revenue_per_trip")
    )


def distance_efficiency(df: DataFrame, by: Sequence[str] = ("taxi_type",)) -> DataFrame:
    """Revenue divided by miles (NULL without miles)."""
    return df.groupBy(*by).agg(
        F.try_divide(F.sum("total_amount"), F.sum("trip_distance")).alias("revenue_per_mile")
    )


def revenue_share(df: DataFrame) -> DataFrame:
    """Revenue per pickup place and its share of all revenue.

    The overall figure is a scalar subquery over the place sums, not a join.
    """
    places = df.groupBy("PULocationID").agg(F.sum("total_amount").alias("total_revenue"))
    overall = places.agg(F.sum("total_revenue")).scalar()
    return places.select(
        "PULocationID",
        "total_revenue",
        F.try_divide(F.col("total_revenue"), overall).alias("revenue_share"),
    ).orderBy(F.desc("total_revenue"), "PULocationID")


def monthly_trend(time_aggregate: DataFrame) -> DataFrame:
    """Trips and revenue per calendar month."""
    return (
        time_aggregate.groupBy("pickup_year", "pickup_month")
        .agg(
            F.sum("total_trips").alias("total_trips"),
            F.sum("total_revenue").alias("total_revenue"),
        )
        .orderBy("pickup_year", "pickup_month")
    )
