"""Rule-based cleaning, its audit and its rejects, and removal of exact duplicates."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fareloom.functions.names import quoted
from fareloom.functions.rules import failed_rules, keep_row, trip_rules
from fareloom.functions.trip_columns import percent_of
from fareloom.operators.copies import MOST_REPEATED, split_copies
from fareloom.sources.schemas import LOAD_COLUMNS
from fareloom.sources.sinks import drop_staged, stage


def clean_trips(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows that pass every rule."""
    return df.filter(keep_row(rules or trip_rules()))


def rejected_trips(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows that fail a rule, with the names of the rules they fail in ``failed_rules``."""
    failed = failed_rules(rules or trip_rules())
    return df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)


def cleaning_audit(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row: rows in, kept, removed and percent removed. One pass over the input."""
    keep = keep_row(rules or trip_rules())
    return kept_and_removed(df, keep)


def rule_failures(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row per rule with the number of rows failing it. One pass over the input."""
    rules = rules or trip_rules()
    counts = df.agg(
        *(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items())
    )
    return counts.unpivot([], list(rules), "rule", "n_failed")


def kept_and_removed(df: DataFrame, keep: Column) -> DataFrame:
    """One row: rows_in, rows_kept, rows_removed, pct_removed for a keep condition."""
    counts = df.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("rows_kept"))
    removed = F.col("rows_in") - F.col("rows_kept")
    return counts.select(
        "rows_in",
        "rows_kept",
        removed.alias("rows_removed"),
        percent_of(removed, F.col("rows_in")).alias("pct_removed"),
    )


def drop_duplicates(
    df: DataFrame, ignore: Sequence[str] = LOAD_COLUMNS, most: int = MOST_REPEATED
) -> DataFrame:
    """One row per distinct value of all columns but ``ignore``, which are those of one of the copies.

    That copy is the one smallest in the ignored columns, taken together in table order. Rows
    whose hash nothing else shares pass through without being moved; only the others are
    grouped, by hash, with copies combined before the shuffle. Filters on the compared columns
    move below all that, down to the scan. The input is scanned several times, and the result reads
    a small staged table: hand in a stored table, within ``staging``. With more than ``most``
    repeated hashes all rows are grouped.
    """
    compared = [c for c in df.columns if c not in ignore]
    loaded = [c for c in df.columns if c in ignore]
    once, again = split_copies(df, compared, most)
    if again is None:
        return df
    if not loaded:
        kept = again.dropDuplicates()
    elif len(loaded) == 1 and not isinstance(df.schema[loaded[0]].dataType, StringType):
        kept = again.groupBy(*map(quoted, compared)).agg(F.min(quoted(loaded[0])).alias(loaded[0]))
    elif once is None:
        # Spark sorts the rows of a task to find a least string.
        least = again.groupBy(*map(quoted, compared)).agg(F.min(F.struct(*map(quoted, loaded))).alias("__copy"))
        kept = least.select(*map(quoted, compared), *(F.col("__copy").getField(c).alias(c) for c in loaded))
    else:
        kept = _of_least_load(stage(again, "copies", infer=False), compared, loaded, most)
    kept = kept.select(*map(quoted, df.columns))
    return kept if once is None else once.unionByName(kept)


def _of_least_load(copies: DataFrame, compared: list[str], loaded: list[str], most: int) -> DataFrame:
    """A row per distinct value of ``compared``, the least in ``loaded``, whose values are numbered in order.

    The least of numbers is found by hash, that of strings by sorting. ``copies`` is a stored
    table, with far fewer loads than rows; their numbers are broadcast up to ``most`` of them.
    """
    loads = copies.select(*map(quoted, loaded)).distinct().orderBy(*map(quoted, loaded))
    counted = Observation()
    numbered = loads.withColumn("__load", F.monotonically_increasing_id())
    places = stage(numbered.observe(counted, F.count(F.lit(1)).alias("n")), "loads", infer=False)
    few = F.broadcast if counted.get["n"] <= most else lambda df: df
    named = places.select("__load", *(quoted(c).alias(f"__{k}") for k, c in enumerate(loaded)))
    same = reduce(and_, (quoted(c).eqNullSafe(F.col(f"__{k}")) for k, c in enumerate(loaded)))
    least = copies.join(few(named), same).groupBy(*map(quoted, compared)).agg(F.min("__load").alias("__load"))
    return least.join(few(places), "__load")
