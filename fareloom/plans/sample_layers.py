"""The layers of the sample trips, stored once per session and read by the queries.

The order tables are joined once and the result is kept as delivered files, one folder per
feed; bronze, silver and gold are stored from there the way any delivery would be. They live
in the session's shared folder. The given tables are taken not to change while a session lasts.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.plans import medallion, sample_trips
from fareloom.plans.medallion import Layout
from fareloom.plans.sample_trips import FEEDS
from fareloom.sources.readers import load_from_parquet
from fareloom.sources.sinks import new_folder, save_to_parquet

_stored: dict[tuple[str, str, str], str] = {}


def _stored_once(
    spark: SparkSession, sf_dir: str, step: str, folder: str | None, store: Callable[[str], None]
) -> str:
    """The folder of ``step``, storing it there the first time this session asks."""
    key = (spark.sparkContext.applicationId, sf_dir, step)
    if key not in _stored:
        path = folder or new_folder(spark, step, owned=False)
        store(path)
        _stored[key] = path
    return _stored[key]


def delivered(spark: SparkSession, sf_dir: str) -> str:
    """Folder of delivered files, one subfolder ``feed=<name>`` per feed."""

    def store(path: str) -> None:
        trips = sample_trips.delivered_trips(spark, sf_dir)
        save_to_parquet(trips, path, partition_by=["feed"], rebalance=False)

    return _stored_once(spark, sf_dir, "delivered", None, store)


def raw_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed as delivered."""
    return sample_trips.as_feed(load_from_parquet(spark, delivered(spark, sf_dir)), feed)


def bronze_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """Layout whose bronze layer is stored."""

    def store(path: str) -> None:
        feeds = {feed: raw_feed(spark, sf_dir, feed) for feed in FEEDS}
        medallion.build_bronze(Layout(path), feeds, sample_trips.zone_lookup(spark, sf_dir))

    return Layout(_stored_once(spark, sf_dir, "layers", None, store))


def prepared(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's bronze trips up to the point where outliers are looked for, stored."""

    def store(path: str) -> None:
        bronze = load_from_parquet(spark, bronze_layout(spark, sf_dir).bronze(feed))
        save_to_parquet(medallion.prepare(bronze), path)

    return load_from_parquet(
        spark, _stored_once(spark, sf_dir, f"prepared_{feed}", None, store)
    )


def silver_feed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """A feed's stored silver trips."""
    return load_from_parquet(spark, silver_layout(spark, sf_dir).silver(feed))


def silver_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """Layout whose bronze and silver layers are stored."""
    root = bronze_layout(spark, sf_dir).root

    def store(path: str) -> None:
        medallion.build_silver(spark, Layout(path), FEEDS)

    return Layout(_stored_once(spark, sf_dir, "silver", root, store))


def gold_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """Layout whose three layers are stored."""
    root = silver_layout(spark, sf_dir).root

    def store(path: str) -> None:
        medallion.build_gold(spark, Layout(path), FEEDS)

    return Layout(_stored_once(spark, sf_dir, "gold", root, store))
