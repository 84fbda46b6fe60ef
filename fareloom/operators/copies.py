"""Rows that occur more than once, found by a hash of the row.

Comparing rows whole moves every row between machines. Here a 64-bit hash is counted first, which
moves 16 bytes a distinct row, or less where copies meet within a task. Only rows whose hash is met
more than once are then compared whole; as a rule these are the copies and nothing else.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

from fareloom.functions.names import quoted
from fareloom.sources.sinks import drop_staged, stage, staging

# Hashes that are broadcast at most, of 8 bytes each; beyond that all rows are compared whole.
MOST_REPEATED = 1 << 20
ROW_HASH = "__row_hash"


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or _has_map(getattr(kind, "elementType", None) or StructType())


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A hash that rows equal in ``columns`` share. Columns with maps, which have none, are left out."""
    return F.xxhash64(F.lit(0), *(quoted(c) for c in columns if not _has_map(df.schema[c].dataType)))


def split_copies(
    df: DataFrame, columns: Sequence[str], most: int = MOST_REPEATED
) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows that certainly differ from all others in ``columns``, and rows that may not.

    Either is None where there are no such rows. The input is scanned once here and once for
    each part. The parts read a small staged table, so use them within ``staging``. More than
    ``most`` repeated hashes leave all rows in the second part.
    """
    hashed = df.withColumn(ROW_HASH, row_hash(df, columns))
    counted = Observation()
    repeated = hashed.groupBy(ROW_HASH).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(ROW_HASH)
    marks = stage(repeated.observe(counted, F.count(F.lit(1)).alias("n")), "repeated", infer=False)
    n = counted.get["n"]
    if 0 < n <= most:
        once, again = (hashed.join(F.broadcast(marks), ROW_HASH, how).drop(ROW_HASH) for how in ("left_anti", "left_semi"))
        return once, again
    drop_staged(marks)
    return (df, None) if n == 0 else (None, df)


def count_copies(df: DataFrame, columns: Sequence[str], most: int = MOST_REPEATED) -> int:
    """How many rows equal an earlier one in ``columns``."""
    with staging(df.sparkSession):
        _, again = split_copies(df, columns, most)
        if again is None:
            return 0
        groups = again.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).first()[0]
