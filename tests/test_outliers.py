"""Exact quantiles and the outlier filters."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareloom.operators import quantiles
from fareloom.operators.outliers import (
    Bounds,
    bounds_table,
    fit_bounds,
    outlier_audit,
    remove_outliers,
)
from fareloom.operators.quantiles import exact_quantiles

PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def by_sorting(values, probabilities):
    ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return [ordered[max(1, math.ceil(p * len(ordered))) - 1] if ordered else None for p in probabilities]


def same(left, right):
    return all(a == b or (a is not None and b is not None and a != a and b != b) for a, b in zip(left, right, strict=True))


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize(
    "values",
    [
        [7.0],
        [1.0, 2.0],
        [5.0] * 50 + [1.0],
        [None, None],
        [float(i % 13) for i in range(200)],
        [10.0**i for i in range(-300, 300, 7)] + [-(10.0**i) for i in range(-300, 300, 7)],
        [float("inf"), -float("inf"), 0.0, 5e-324, 1e-323, -5e-324, 1.0],
        [float("nan"), 1.0, 2.0, None, 3.0],
        [-1.7e308, 1.7e308, 0.0, 1.0],
    ],
)
def test_narrowing_equals_sorting(spark, values):
    found = exact_quantiles(numbers(spark, values), {"x": PROBABILITIES})["x"]
    assert same(found, by_sorting(values, PROBABILITIES))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=60))
def test_narrowing_equals_sorting_on_any_doubles(spark, values):
    found = exact_quantiles(numbers(spark, values), {"x": (0.25, 0.75)})["x"]
    assert found == by_sorting(values, (0.25, 0.75))


def test_narrowing_takes_several_rounds_when_buckets_are_few(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BUCKETS", 2)
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", 8)
    df = spark.range(5000).select((F.hash("id") / 7).alias("x"))
    values = [r.x for r in df.collect()]
    assert exact_quantiles(df, {"x": PROBABILITIES})["x"] == by_sorting(values, PROBABILITIES)


def test_several_columns_share_the_passes(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    targets = {"l_extendedprice": (0.25, 0.5, 0.75), "l_tax": (0.5,), "l_linenumber": (0.9,)}
    rows = df.select(*targets).collect()
    assert exact_quantiles(df, targets) == {c: by_sorting([float(r[c]) for r in rows], p) for c, p in targets.items()}


def test_buckets_of_all_targets_form_few_groups(spark):
    df = spark.range(20000).select((F.hash("id") / 7).alias("x"))
    targets = [quantiles._Target("x", 1, -1e8, 1e8), quantiles._Target("x", 1, -5e7, 2e8)]
    groups = quantiles._histogram(df, ["x"], targets)
    assert sum(g.n for g in groups) == 20000
    assert len(groups) <= 2 * (quantiles.BUCKETS + 5)


def table(spark, rows):
    return spark.createDataFrame(rows, "a double, b double")


def test_bounds_of_a_later_column_come_from_the_rows_kept_so_far(spark):
    rows = [(float(i), float(i)) for i in range(1, 12)] + [(1000.0, -500.0)]
    sequential = fit_bounds(table(spark, rows), ["a", "b"])
    at_once = fit_bounds(table(spark, rows), ["a", "b"], sequential=False)
    assert sequential[0] == at_once[0]
    assert (sequential[1].q1, sequential[1].q3) == (3.0, 9.0)
    assert (at_once[1].q1, at_once[1].q3) == (2.0, 8.0)


def chain_by_sorting(rows, columns, factor=1.5):
    """Bounds of one column after another, the plain way."""
    out = []
    for k in range(columns):
        values = sorted((r[k] for r in rows if r[k] is not None), key=lambda v: (v != v, v))
        if not values:
            out.append((None, None))
            rows = []
            continue
        q1, q3 = (values[max(1, math.ceil(p * len(values))) - 1] for p in (0.25, 0.75))
        low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
        rows = [r for r in rows if r[k] is not None and low <= r[k] <= high]
        out.append((q1, q3))
    return out


@pytest.mark.parametrize("buckets, sketch", [(2048, 2048), (3, 8)])
def test_a_chain_of_columns_equals_sorting(spark, monkeypatch, buckets, sketch):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", sketch)
    rng = random.Random(buckets)
    heavy = lambda: rng.choice([None, rng.gauss(0, 1), rng.gauss(0, 40), float(rng.randrange(4)), 10.0 ** rng.randrange(9)])
    rows = []
    for _ in range(3000):
        a = heavy()
        rows.append((a, heavy() if a is None or a < 5 else -1000.0, heavy(), (a or 0.0) * rng.random()))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert [(b.q1, b.q3) for b in fit_bounds(df, ["a", "b", "c", "d"])] == chain_by_sorting(rows, 4)


def test_a_chain_in_which_nothing_is_left(spark):
    rows = [(1.0, None, 5.0), (2.0, None, 6.0), (None, 3.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert [(b.q1, b.q3) for b in fit_bounds(df, ["a", "b", "c"])] == [(1.0, 2.0), (None, None), (None, None)]


def test_a_chain_takes_about_a_scan_a_column(spark, monkeypatch):
    scans, histogram = [0], quantiles._histogram
    monkeypatch.setattr(quantiles, "_histogram", lambda *args: scans.__setitem__(0, scans[0] + 1) or histogram(*args))
    columns = [(F.hash("id", F.lit(k)) % 100_003 / 7).alias(f"c{k}") for k in range(4)]
    fit_bounds(spark.range(50_000).select(*columns), ["c0", "c1", "c2", "c3"])
    assert scans[0] <= 5


def test_moments_come_with_the_counts(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("a"), F.lit(None).cast("double").alias("b")).repartition(5)
    found = quantiles.quantiles_and_moments(df, {"a": (0.5,), "b": (0.5,)})[1]
    want = df.agg(F.avg("a"), F.stddev_samp("a"), F.min("a"), F.max("a")).first()
    got = found["a"]
    assert (got.mean, got.deviation(), got.smallest, got.largest) == pytest.approx(tuple(want))
    assert found["b"] == quantiles.Moments(0, None, None, None, None)


def test_bounds_are_inclusive_and_nulls_drop(spark):
    rows = [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0), (4.0, 0.0), (None, 0.0), (7.0, 0.0), (-2.0, 0.0)]
    df = table(spark, rows)
    (bounds,) = fit_bounds(df, ["a"])
    assert (bounds.q1, bounds.q3) == (1.0, 4.0)
    assert (bounds.lower, bounds.upper) == (-3.5, 8.5)
    edge = table(spark, [(-3.5, 0.0), (8.5, 0.0), (8.51, 0.0), (None, 0.0)])
    assert edge.filter(bounds.holds()).count() == 2


def test_constant_column_keeps_only_its_value(spark):
    df = table(spark, [(5.0, 0.0)] * 9 + [(6.0, 0.0)])
    assert remove_outliers(df, ["a"]).count() == 9


@pytest.mark.parametrize("method", ["iqr", "zscore", "IQR"])
def test_empty_table_stays_empty(spark, method):
    df = table(spark, [(1.0, 1.0)]).limit(0)
    assert remove_outliers(df, ["a", "b"], method).count() == 0


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError, match="unknown outlier method"):
        remove_outliers(table(spark, [(1.0, 1.0)]), ["a"], "mad")


def test_zscore_keeps_what_is_near_the_mean(spark):
    df = table(spark, [(float(i % 5), 0.0) for i in range(100)] + [(1000.0, 0.0)])
    assert remove_outliers(df, ["a"], "zscore").count() == 100
    assert remove_outliers(table(spark, [(3.0, 0.0)]), ["a"], "zscore").count() == 1


def test_approximate_quartiles_on_request(spark):
    df = table(spark, [(float(i), 0.0) for i in range(1000)])
    (bounds,) = fit_bounds(df, ["a"], accuracy=100)
    assert abs(bounds.q1 - 249) <= 10 and abs(bounds.q3 - 749) <= 10


def test_audit_and_table_of_bounds(spark):
    bounds = [Bounds("a", 0.0, 2.0, 0.5, 1.5)]
    audit = outlier_audit(table(spark, [(1.0, 0.0), (3.0, 0.0), (None, 0.0), (2.0, 0.0)]), bounds)
    assert tuple(audit.first()) == (4, 2, 2, 50.0)
    assert tuple(bounds_table(spark, bounds).first()) == (1, "a", 0.5, 1.5, 0.0, 2.0)


def test_the_filter_scans_the_stored_table_with_literal_bounds(spark, plan):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    text = plan(remove_outliers(df, ["a", "b"]))
    assert "Join" not in text and "Exchange" not in text
    assert "LessThanOrEqual(a," in text
