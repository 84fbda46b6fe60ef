"""What is left in the shared folder: nothing that a scope owns."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareloom.operators.cleaning import drop_duplicates
from fareloom.operators.outliers import remove_outliers
from fareloom.operators.quality import duplicate_profile, quality_report
from fareloom.plans import medallion, sample_layers
from fareloom.plans.sample_trips import FEEDS
from fareloom.sources.sinks import new_folder, save_to_parquet, shared_folder, stage, staging

SF_DIR = "/root/testdata/sf0.001"


def held(spark):
    """Folders in the shared folder that have a file."""
    root = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name for p in root.glob("*") if any(f.is_file() for f in p.rglob("*"))}


def test_a_scope_deletes_its_tables_also_after_an_error(spark):
    before = held(spark)
    with staging(spark):
        outer = stage(spark.range(5))
        with staging(spark):
            assert stage(spark.range(7)).count() == 7
            assert len(held(spark) - before) == 2
        assert outer.count() == 5 and len(held(spark) - before) == 1
        kept = new_folder(spark, "kept", owned=False)
        spark.range(2).write.parquet(kept)
    with pytest.raises(RuntimeError), staging(spark):
        stage(spark.range(5))
        raise RuntimeError
    assert held(spark) - before == {Path(kept).parent.name}


def test_layers_leave_nothing_behind(spark, tmp_path):
    feeds = {feed: sample_layers.raw_feed(spark, SF_DIR, feed) for feed in FEEDS}
    zones = sample_layers.sample_trips.zone_lookup(spark, SF_DIR)
    layout = medallion.Layout(str(tmp_path / "out"))
    medallion.build_bronze(layout, feeds, zones)
    before = held(spark)
    medallion.build_silver(spark, layout, FEEDS)
    medallion.build_gold(spark, layout, FEEDS)
    with staging(spark):
        save_to_parquet(medallion.refine(spark.read.parquet(layout.bronze("yellow"))), str(tmp_path / "refined"))
    assert held(spark) == before
    stored = spark.read.parquet(layout.silver("yellow")).drop("processed_timestamp")
    again = spark.read.parquet(str(tmp_path / "refined")).drop("processed_timestamp")
    assert stored.count() == again.count() and stored.exceptAll(again).count() == 0


def test_reports_leave_nothing_behind_and_results_can_be_used_in_a_scope(spark):
    df = spark.range(60).select((F.col("id") % 50).cast("double").alias("a"), F.lit("x").alias("source_file"))
    before = held(spark)
    assert duplicate_profile(df).first().duplicate_count == 10
    quality_report(df).collect()
    with staging(spark):
        assert drop_duplicates(df).count() == 50
        assert remove_outliers(df, ["a"]).count() == 60
    assert held(spark) == before
