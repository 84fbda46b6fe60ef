"""Session construction, and shuffle sizing for a given amount of input."""

import math

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Rows take about three times the space of the compressed columns they were read from.
ROW_EXPANSION = 3
PARTITION_BYTES = 512 * 1024**2


def get_spark(app_name: str = "fareloom", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with a UTC clock and adaptive execution; ``conf`` is applied last."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    } | (conf or {})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, *folders: str, partition_bytes: int | None = None) -> int:
    """Raise the session's shuffle partitions to suit a full shuffle of the files in ``folders``.

    Adaptive execution merges partitions that turn out small but does not split those of an
    aggregate that turn out large, so the number has to start high enough. It is never lowered.
    ``partition_bytes`` is the amount of rows wanted in a partition, 512 MB unless given.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(folders))
    stored = files.agg(F.sum("length")).first()[0] or 0
    wanted = math.ceil(stored * ROW_EXPANSION / (partition_bytes or PARTITION_BYTES))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)
