"""Outlier bounds per column, and the filter and audit built from them."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.cleaning import kept_and_removed
from fareloom.operators.quantiles import chained_quantiles, exact_quantiles
from fareloom.sources.sinks import stage

# The columns examined, in this order, and the width of the quartile fence.
OUTLIER_COLUMNS = ("trip_distance", "trip_duration_minutes", "fare_amount", "total_amount")
IQR_FACTOR = 1.5

# Standard deviations kept on either side of the mean; our choice.
ZSCORE_FACTOR = 3.0


@dataclass(frozen=True)
class Bounds:
    """Closed interval a column must lie in; no interval if the column had no values."""

    column: str
    lower: float | None
    upper: float | None
    q1: float | None = None
    q3: float | None = None

    def holds(self) -> Column:
        if self.lower is None:
            return F.lit(False)
        return F.col(self.column).between(self.lower, self.upper)


def within(bounds: Sequence[Bounds]) -> Column:
    """Every bounded column is present and inside its interval."""
    return reduce(and_, (b.holds() for b in bounds), F.lit(True))


def fit_bounds(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    method: str = "iqr",
    factor: float | None = None,
    sequential: bool = True,
    accuracy: int | None = None,
) -> list[Bounds]:
    """Bounds of each column.

    With ``sequential`` the bounds of a column come from the rows that are within the
    bounds of the columns before it; otherwise all bounds come from the whole input,
    in one go. Quartiles are exact unless ``accuracy`` asks for an approximate digest.
    The input is scanned several times, reading only the columns examined.
    """
    fit = {"iqr": _iqr, "zscore": _zscore}.get(method.lower())
    if fit is None:
        raise ValueError(f"unknown outlier method {method!r}; use 'iqr' or 'zscore'")
    if not sequential:
        return fit(df, columns, factor, accuracy)
    if fit is _iqr and accuracy is None and len(set(columns)) == len(columns):
        reach = IQR_FACTOR if factor is None else factor
        quartiles = chained_quantiles(df, list(columns), (0.25, 0.75), lambda c, q: _fence(c, q, reach).holds())
        return [_fence(c, q, reach) for c, q in zip(columns, quartiles, strict=True)]
    bounds: list[Bounds] = []
    for column in columns:
        bounds += fit(df.filter(within(bounds)), [column], factor, accuracy)
    return bounds


def _iqr(
    df: DataFrame, columns: Sequence[str], factor: float | None, accuracy: int | None
) -> list[Bounds]:
    factor = IQR_FACTOR if factor is None else factor
    if accuracy is None:
        quartiles = exact_quantiles(df, {c: (0.25, 0.75) for c in columns})
    else:
        quartiles = (
            df.agg(*(F.percentile_approx(c, [0.25, 0.75], accuracy).alias(c) for c in columns))
            .first()
            .asDict()
        )
    return [_fence(column, quartiles[column], factor) for column in columns]


def _fence(column: str, quartiles: Sequence[float | None] | None, factor: float) -> Bounds:
    """Bounds that far outside the quartiles; none without quartiles."""
    q1, q3 = quartiles or (None, None)
    if q1 is None:
        return Bounds(column, None, None)
    reach = factor * (q3 - q1)
    return Bounds(column, q1 - reach, q3 + reach, q1, q3)


def _zscore(
    df: DataFrame, columns: Sequence[str], factor: float | None, accuracy: int | None
) -> list[Bounds]:
    factor = ZSCORE_FACTOR if factor is None else factor
    moments = df.agg(
        *(F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns)
    ).first()
    bounds = []
    for column in columns:
        mean, sd = moments[column]
        if mean is None:
            bounds.append(Bounds(column, None, None))
        else:
            reach = factor * (sd or 0.0)
            bounds.append(Bounds(column, mean - reach, mean + reach))
    return bounds


def bounds_table(spark: SparkSession, bounds: Sequence[Bounds]) -> DataFrame:
    """Bounds as rows: step, column_name, q1, q3, lower_bound, upper_bound."""
    return spark.createDataFrame(
        [(i, b.column, b.q1, b.q3, b.lower, b.upper) for i, b in enumerate(bounds, 1)],
        "step int, column_name string, q1 double, q3 double, lower_bound double, upper_bound double",
    )


def remove_outliers(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    method: str = "iqr",
    factor: float | None = None,
    sequential: bool = True,
    accuracy: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """Rows inside the bounds of every column; a NULL in one of them drops the row.

    The input is written once to the shared folder and examined there; the result reads it,
    so whoever stores the result has to delete it. Pass ``staged=True`` if the input already
    is a stored table.
    """
    table = df if staged else stage(df, "outlier_input", infer=False)
    return table.filter(within(fit_bounds(table, columns, method, factor, sequential, accuracy)))


def outlier_audit(df: DataFrame, bounds: Sequence[Bounds]) -> DataFrame:
    """One row: rows in, kept, removed and percent removed. One pass over the input."""
    return kept_and_removed(df, within(bounds))
