"""The three layers: bronze (as delivered), silver (refined), gold (aggregated)."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.aggregates import aggregate_by_time, aggregate_by_zone
from fareloom.operators.cleaning import clean_trips, drop_duplicates
from fareloom.operators.features import add_derived_features
from fareloom.operators.feeds import add_metadata_columns, combine_feeds, standardize_column_names
from fareloom.operators.outliers import remove_outliers
from fareloom.session import size_shuffles
from fareloom.sources.readers import (
    get_file_paths,
    load_from_parquet,
    read_deliveries,
    read_lookup_csv,
    read_merged,
)
from fareloom.sources.schemas import FEED_SCHEMAS, SOURCE_FILE, ZONE_SCHEMA
from fareloom.sources.sinks import save_to_parquet, staging

# Where deliveries are found below the raw folder by default: those of every year and month.
FEED_PATTERNS = {
    "yellow": "taxi/yellow_tripdata_*.parquet",
    "green": "taxi/green_tripdata_*.parquet",
}
ZONE_LOOKUP = "lookup/taxi_zone_lookup.csv"


@dataclass(frozen=True)
class Layout:
    """Where each table of each layer is stored under ``root``; the folder names are fixed values."""

    root: str

    def bronze(self, feed: str) -> str:
        return f"{self.root}/bronze/{feed}_taxi"

    def zones(self) -> str:
        return f"{self.root}/bronze/zone_lookup"

    def silver(self, feed: str) -> str:
        return f"{self.root}/silver/{feed}_taxi"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def raw_feeds(
    spark: SparkSession,
    raw_dir: str,
    patterns: Mapping[str, str] = FEED_PATTERNS,
    drifted: bool = False,
    source_files: bool = False,
) -> dict[str, DataFrame]:
    """The feeds that have deliveries matching their pattern, each as one table.

    A feed has the columns of all its deliveries; a delivery without one has NULLs there, and
    deliveries that store one in different types are an error. With ``drifted`` types may
    differ, and everything is cast to the feed's declared schema. ``source_files`` adds the
    file that each row comes from.
    """
    name = SOURCE_FILE if source_files else None
    feeds = {}
    for feed, pattern in patterns.items():
        if drifted:
            files = get_file_paths(spark, raw_dir, pattern)
            delivered = read_deliveries(spark, files, FEED_SCHEMAS[feed], name) if files else None
        else:
            delivered = read_merged(spark, f"{raw_dir}/{pattern}", name)
        if delivered is not None:
            feeds[feed] = delivered
    return feeds


def ingest(raw: DataFrame, feed: str) -> DataFrame:
    """A delivered feed under common column names, with its lineage columns.

    A feed that was read with its source files keeps them, after the load time.
    """
    named = standardize_column_names(raw, feed)
    if SOURCE_FILE not in raw.columns:
        return add_metadata_columns(named, feed)
    plain = [c for c in named.columns if c != SOURCE_FILE]
    tagged = add_metadata_columns(named, feed, F.col(SOURCE_FILE))
    return tagged.select(*plain, *[c for c in tagged.columns if c not in named.columns], SOURCE_FILE)


def prepare(bronze: DataFrame) -> DataFrame:
    """Bronze trips without copies, cleaned and with the derived columns.

    Copies pass or fail the rules together, so they are looked for among the rows that pass.
    """
    return (
        bronze.transform(clean_trips).transform(drop_duplicates).transform(add_derived_features)
    )


def refine(bronze: DataFrame) -> DataFrame:
    """Prepared trips without outliers. They read tables staged on the way: store them within ``staging``."""
    return prepare(bronze).transform(remove_outliers)


def build_bronze(
    layout: Layout, feeds: Mapping[str, DataFrame], zones: DataFrame | None = None
) -> None:
    """Store each delivered feed, and the zone lookup if given. A feed not listed is skipped."""
    for feed, raw in feeds.items():
        save_to_parquet(ingest(raw, feed), layout.bronze(feed))
    if zones is not None:
        save_to_parquet(zones, layout.zones())


def build_silver(
    spark: SparkSession, layout: Layout, feeds: list[str], partition_by: Sequence[str] = ()
) -> None:
    """Refine the stored bronze feeds, optionally into one folder per year and month, say.

    What is staged on the way is deleted once a feed's silver is stored.
    """
    for feed in feeds:
        with staging(spark):
            trips = refine(load_from_parquet(spark, layout.bronze(feed)))
            save_to_parquet(trips, layout.silver(feed), partition_by=partition_by)


def combined(spark: SparkSession, layout: Layout, feeds: list[str]) -> DataFrame:
    """The stored silver feeds as one table."""
    return combine_feeds(*(load_from_parquet(spark, layout.silver(f)) for f in feeds))


def build_gold(spark: SparkSession, layout: Layout, feeds: list[str]) -> None:
    """Store the combined trips, and the zone and time aggregates in their sort order."""
    trips = combined(spark, layout, feeds)
    zones = load_from_parquet(spark, layout.zones())
    save_to_parquet(trips, layout.gold("combined_taxi_data"))
    save_to_parquet(aggregate_by_zone(trips, zones), layout.gold("zone_analytics"))
    save_to_parquet(aggregate_by_time(trips), layout.gold("time_analytics"))


def run(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    patterns: Mapping[str, str] = FEED_PATTERNS,
    drifted: bool = False,
    partition_by: Sequence[str] = (),
    source_files: bool = False,
) -> Layout:
    """From delivered files and the zone lookup to all three stored layers.

    ``partition_by`` lays silver out in folders; ``source_files`` keeps the file of every row.
    """
    layout = Layout(out_dir)
    size_shuffles(spark, raw_dir)
    feeds = raw_feeds(spark, raw_dir, patterns, drifted, source_files)
    if not feeds:
        raise ValueError(f"no deliveries found in {raw_dir}")
    zones = read_lookup_csv(spark, f"{raw_dir}/{ZONE_LOOKUP}", ZONE_SCHEMA)
    build_bronze(layout, feeds, zones)
    build_silver(spark, layout, list(feeds), partition_by)
    build_gold(spark, layout, list(feeds))
    return layout
