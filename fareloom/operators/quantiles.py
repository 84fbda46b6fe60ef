"""Exact quantiles without sorting and without gathering values in one place.

A quantile is the smallest value whose rank is at least ``ceil(p * n)``, n counting
the non-NULL values. Approximate digests answer that with an error that grows with n,
and one precise enough to be exact is as large as the data. Here a small sketch gives a first
bracket around each quantile and the bracket is then narrowed: every round
counts the rows in evenly spaced buckets inside the bracket, picks the bucket that holds
the wanted rank and continues with that bucket's smallest and largest value, until
they are equal. A round is one scan with a partial aggregate; what reaches the driver is a
few thousand bucket counts whatever the size of the table. A wrong first bracket costs
a round, not the result, because rows outside it are counted as well.

Quantiles of columns of which each filters the next are found together: while one column's
brackets are narrowed, those after it are narrowed over the rows that the guesses so far keep.
A column counts as found only by a scan in which all filters before it were final.
"""

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from fareloom.functions.names import quoted

BUCKETS = 2048

# Sketches of this size are off by less than the slack in rank, bar rare cases that cost a round.
SKETCH_SIZE = 2048
SLACK = 0.002
# Columns whose rows another one filters are looked for in so many ranks more on either side.
FILTERED_SLACK = 0.05
MERGE_GROUPS = 256


@dataclass
class _Target:
    """One quantile being searched for, and the values it is known to lie between."""

    column: str
    rank: int
    low: float
    high: float
    found: bool = False
    p: float = 0.0

    def narrow(self, groups: list[Row], margin: bool = False) -> None:
        """Move to the group of values, given in ascending order, that holds the rank.

        With ``margin`` the groups next to it inside the bracket are taken as well, or else the
        next value: the rank is that of rows which are not final.
        """
        seen = 0
        for k, group in enumerate(groups):
            seen += group["n"]
            if seen >= self.rank:
                low, high = group["smallest"], group["largest"]
                if margin and k > 0:
                    before = groups[k - 1]
                    low = before["smallest"] if before["smallest"] >= self.low else before["largest"]
                if margin and k + 1 < len(groups):
                    after = groups[k + 1]
                    high = after["largest"] if after["largest"] <= self.high else after["smallest"]
                self.low, self.high = low, high
                self.found = not margin and (low == high or math.isnan(low))
                return

    def guess(self) -> float:
        return self.low if self.low == self.high else self.low / 2 + self.high / 2


@dataclass(frozen=True)
class Moments:
    """Count, mean, sum of squared distances from it, smallest and largest of a column's values."""

    n: int
    mean: float | None
    squares: float | None
    smallest: float | None
    largest: float | None

    def deviation(self) -> float | None:
        """The sample standard deviation; None for fewer than two values."""
        return math.sqrt(self.squares / (self.n - 1)) if self.n > 1 else None


def exact_quantiles(
    df: DataFrame, targets: Mapping[str, Sequence[float]]
) -> dict[str, list[float | None]]:
    """Quantiles of numeric columns, compared as doubles; None for a column without values.

    ``targets`` maps a column to the probabilities wanted. All columns share each pass.
    NaN is larger than any other value. The input is scanned a few times, so hand in a
    stored table rather than a long plan. Tables of any size go the same way.
    """
    return quantiles_and_moments(df, targets, moments=False)[0]


def quantiles_and_moments(
    df: DataFrame, targets: Mapping[str, Sequence[float]], moments: bool = True
) -> tuple[dict[str, list[float | None]], dict[str, Moments]]:
    """``exact_quantiles``, and the moments of each column, counted in the first of its scans after the sketches."""
    searches = _first_brackets(df, targets)
    found = {c: Moments(0, None, None, None, None) for c in targets}
    first = moments
    while open_ := [t for group in searches.values() for t in group if not t.found]:
        columns = list(dict.fromkeys(t.column for t in open_))
        histogram = _histogram(df, columns, open_, None, first)
        for series, column in enumerate(columns):
            groups = _ascending(histogram, series)
            for target in (t for t in open_ if t.column == column):
                target.narrow(groups)
            if first:
                found[column] = _merged(groups)
        first = False
    quantiles = {
        c: [t.low for t in searches[c]] if searches[c] else [None] * len(probabilities)
        for c, probabilities in targets.items()
    }
    return quantiles, found


def chained_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keep: Callable[[str, list[float] | None], Column],
) -> list[list[float] | None]:
    """Quantiles of each column over the rows that those before it keep; None where no value is left.

    ``keep`` makes the condition for later columns from a column and its quantiles. Scans are
    about one more than columns: each column is narrowed in all of them.
    """
    slack = dict.fromkeys(columns, FILTERED_SLACK) | dict.fromkeys(columns[:1], SLACK)
    found = _first_brackets(df, dict.fromkeys(columns, probabilities), slack)
    searches = [[replace(t) for t in found[c]] for c in columns]
    known: list[list[float] | None] = []
    while len(known) < len(columns):
        first, rest = len(known), columns[len(known) :]
        if not searches[first]:
            known.append(None)
            continue
        final = reduce(and_, map(keep, columns, known), F.lit(True))
        kept = [F.lit(True)]
        for c, group in zip(rest[:-1], searches[first:], strict=False):
            kept.append(kept[-1] & F.coalesce(keep(c, [t.guess() for t in group] or None), F.lit(False)))
        histogram = _histogram(df.filter(final), rest, [t for group in searches[first:] for t in group], kept)
        for series, group in enumerate(searches[first:]):
            values = _ascending(histogram, series)
            n = sum(g["n"] for g in values)
            for target in group if n else []:
                target.rank = max(1, math.ceil(target.p * n))
                target.narrow(values, margin=series > 0)
            if series == 0 and not n:
                known.append(None)
            elif series == 0 and all(t.found for t in group):
                known.append([t.low for t in group])
    return known


def _ascending(histogram: list[Row], series: int) -> list[Row]:
    own = (g for g in histogram if g["series"] == series)
    return sorted(own, key=lambda g: (math.isnan(g["smallest"]), g["smallest"]))


def _merged(groups: list[Row]) -> Moments:
    """The moments of a column's values from those of groups of them, in ascending order."""
    n = sum(g["n"] for g in groups)
    if not n:
        return Moments(0, None, None, None, None)
    mean = sum(g["n"] * g["mean"] for g in groups) / n
    # Products, unlike powers, become infinite or no number where doubles end.
    squares = sum(g["squares"] + g["n"] * (g["mean"] - mean) * (g["mean"] - mean) for g in groups)
    return Moments(n, mean, squares, groups[0]["smallest"], groups[-1]["largest"])


def _first_brackets(
    df: DataFrame, targets: Mapping[str, Sequence[float]], slack: Mapping[str, float] | None = None
) -> dict[str, list[_Target]]:
    """A guess around each quantile from mergeable sketches of bounded size.

    Sketches of the tasks are merged in groups and the groups' in one, so that no
    single task receives a sketch from every task of a large scan.
    """
    series = range(len(targets))
    values = df.select(*(quoted(c).cast("double").alias(f"v{i}") for i, c in enumerate(targets)))
    groups = values.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("merge_group")).agg(
        *(F.count(f"v{i}").alias(f"n{i}") for i in series),
        *(F.kll_sketch_agg_double(f"v{i}", SKETCH_SIZE).alias(f"sketch{i}") for i in series),
    )
    sketches = groups.agg(
        *(F.sum(f"n{i}").alias(f"n{i}") for i in series),
        *(F.kll_merge_agg_double(f"sketch{i}", SKETCH_SIZE).alias(f"sketch{i}") for i in series),
    )
    ends = []
    for i, (column, probabilities) in enumerate(targets.items()):
        sketch, reach = F.col(f"sketch{i}"), (slack or {}).get(column, SLACK)
        sides = [min(1.0, max(0.0, p + side)) for p in probabilities for side in (-reach, reach)]
        # A sketch leaves NaN out and is empty if there is nothing else.
        ends.append(
            F.when(
                F.kll_sketch_get_n_double(sketch) > 0,
                F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, sides))),
            ).alias(f"ends{i}")
        )
    guess = sketches.select(*(f"n{i}" for i in series), *ends).first()
    searches = {}
    for i, (column, probabilities) in enumerate(targets.items()):
        rows = guess[f"n{i}"] or 0
        sides = guess[f"ends{i}"] or [-math.inf, math.inf] * len(probabilities)
        searches[column] = [
            _Target(column, max(1, math.ceil(p * rows)), sides[2 * j], sides[2 * j + 1], p=p)
            for j, p in enumerate(probabilities)
            if rows
        ]
    return searches


def _bucket(value: Column, low: Column, high: Column, width: Column) -> Column:
    """Order-preserving bucket number; each end of the bracket has a bucket to itself."""
    inside = F.floor((value / 2 - low / 2) / width * BUCKETS) + 1
    return (
        F.when(value < low, -1)
        .when(value == low, 0)
        .when(value == high, BUCKETS + 2)
        .when(value > high, BUCKETS + 3)
        .otherwise(F.coalesce(inside, F.lit(1)))
    )


def _histogram(
    df: DataFrame,
    columns: Sequence[str],
    targets: list[_Target],
    kept: Sequence[Column] | None = None,
    moments: bool = False,
) -> list[Row]:
    """Rows per (series, bucket of every target): n, smallest, largest; with ``moments`` also mean and squares.

    A series is a column, over the rows that its condition in ``kept`` holds for.

    Buckets of several targets rise together with the value, so grouping on all of
    them at once yields no more groups than the targets have buckets in total. The brackets
    are looked up by series and not spelled out, so that code generated for one scan serves the next.
    """
    pairs = [
        F.struct(
            F.lit(i).alias("series"),
            (F.when(kept[i], quoted(c).cast("double")) if kept else quoted(c).cast("double")).alias("value"),
        )
        for i, c in enumerate(columns)
    ]
    values = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    of_series = [[t for t in targets if t.column == c] or [_Target(c, 1, 0.0, 0.0)] for c in columns]
    keys = []
    for slot in range(max(map(len, of_series))):
        # A series with fewer targets repeats one.
        own = [group[min(slot, len(group) - 1)] for group in of_series]

        def of(numbers: list[float | None]) -> Column:
            return F.get(F.array(*(F.lit(x).cast("double") for x in numbers)), F.col("series"))

        # Halved, so that the width of a bracket spanning all doubles is still finite.
        widths = [t.high / 2 - t.low / 2 if t.low < t.high else None for t in own]
        sides = of([t.low for t in own]), of([t.high for t in own]), of(widths)
        keys.append(_bucket(F.col("value"), *sides).alias(f"b{slot}"))
    figures = [
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
    ]
    if moments:
        figures += [F.avg("value").alias("mean"), (F.var_pop("value") * F.count(F.lit(1))).alias("squares")]
    names = ["series", "n", "smallest", "largest", *(["mean", "squares"] if moments else [])]
    return values.groupBy("series", *keys).agg(*figures).select(*names).collect()
