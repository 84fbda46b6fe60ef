"""Bringing feeds to one shape: names, lineage columns, common columns, union."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.sources.schemas import FEED, FEED_RENAMES, PROCESSED_AT, SOURCE_FILE


def standardize_column_names(df: DataFrame, taxi_type: str) -> DataFrame:
    """Give the feed's time columns their common names; an unknown feed is left as it is."""
    return df.withColumnsRenamed(FEED_RENAMES.get(taxi_type.lower(), {}))


def add_metadata_columns(
    df: DataFrame, taxi_type: str, file_path: str | Column | None = None
) -> DataFrame:
    """Add the feed name, the load time and, if asked for, the source file.

    For a scan of many files pass ``file_path=F.col("_metadata.file_path")`` to record
    the file each row came from.
    """
    added = {FEED: F.lit(taxi_type), PROCESSED_AT: F.current_timestamp()}
    if file_path is not None:
        added[SOURCE_FILE] = file_path if isinstance(file_path, Column) else F.lit(file_path)
    return df.withColumns(added)


def column_overlap(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Column names in both tables, only in the left and only in the right, in table order."""
    return {
        "common": [c for c in left.columns if c in right.columns],
        "left_only": [c for c in left.columns if c not in right.columns],
        "right_only": [c for c in right.columns if c not in left.columns],
    }


def combine_feeds(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds on the columns they share, in the first feed's order."""
    if not feeds:
        raise ValueError("no feed to combine")
    shared = [c for c in feeds[0].columns if all(c in f.columns for f in feeds[1:])]
    return reduce(DataFrame.unionByName, (f.select(*shared) for f in feeds))
