"""Readers, writers, staging, schemas and feeds."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareloom import session
from fareloom.__main__ import main
from fareloom.operators.feeds import (
    add_metadata_columns,
    column_overlap,
    combine_feeds,
    standardize_column_names,
)
from fareloom.plans import medallion
from fareloom.plans.medallion import Layout, build_bronze, build_gold, build_silver, run
from fareloom.plans.sample_trips import FEEDS, as_feed, delivered_trips, zone_lookup
from fareloom.sources import (
    FEED_SCHEMAS,
    GREEN_SCHEMA,
    YELLOW_SCHEMA,
    ZONE_SCHEMA,
    conform,
    file_row_counts,
    get_file_paths,
    is_valid,
    list_files,
    load_from_parquet,
    read_deliveries,
    read_lookup_csv,
    read_parquet,
    read_text_lines,
    save_to_parquet,
    stage,
    validate_schema,
)
from fareloom.sources.sinks import drop_folder, drop_staged, shared_folder

SF_DIR = "/root/testdata/sf0.001"


def test_declared_schemas():
    assert (len(YELLOW_SCHEMA), len(GREEN_SCHEMA), len(ZONE_SCHEMA)) == (20, 20, 4)
    shared = set(YELLOW_SCHEMA.fieldNames()) & set(GREEN_SCHEMA.fieldNames())
    assert len(shared) == 16
    assert all(f.nullable for s in (YELLOW_SCHEMA, GREEN_SCHEMA, ZONE_SCHEMA) for f in s)


def test_files_are_found_by_pattern_and_sorted(spark, tmp_path):
    for name in ("b-2.txt", "b-1.txt", "c.txt"):
        (tmp_path / name).write_text("x")
    assert [p.rsplit("/", 1)[1] for p in get_file_paths(spark, str(tmp_path), "b-*.txt")] == ["b-1.txt", "b-2.txt"]
    assert get_file_paths(spark, str(tmp_path), "z*") == []
    listing = list_files(spark, str(tmp_path), "*.txt")
    assert [r.length for r in listing.collect()] == [1, 1, 1]


def test_several_files_in_one_scan(spark, tmp_path):
    for name in ("m1", "m2"):
        spark.range(3).write.parquet(str(tmp_path / name))
    assert read_parquet(spark, [str(tmp_path / "m1"), str(tmp_path / "m2")]).count() == 6
    counts = file_row_counts(read_parquet(spark, str(tmp_path / "m*")))
    assert counts.agg(F.sum("n_rows")).first()[0] == 6


def test_declared_schema_widens_stored_types(spark, tmp_path):
    spark.range(3).select(F.col("id").cast("int")).write.parquet(str(tmp_path / "t"))
    df = read_parquet(spark, str(tmp_path / "t"), StructType.fromDDL("id long"))
    assert df.dtypes == [("id", "bigint")] and df.agg(F.sum("id")).first()[0] == 3


def test_drifted_deliveries_read_as_one_table(spark, tmp_path):
    declared = StructType.fromDDL("id long, n long, note string")
    spark.createDataFrame([(1, 10)], "id int, n int").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2, 20.0, 1)], "id long, n double, extra int").write.parquet(str(tmp_path / "b"))
    spark.createDataFrame([(3, 30)], "id int, n int").write.parquet(str(tmp_path / "c"))
    df = read_deliveries(spark, [str(tmp_path / x) for x in "abc"], declared)
    assert df.schema.simpleString() == declared.simpleString()
    assert sorted(map(tuple, df.collect())) == [(1, 10, None), (2, 20, None), (3, 30, None)]
    assert len(df.inputFiles()) >= 3
    assert read_deliveries(spark, [], declared).count() == 0


def test_lookup_csv(spark, tmp_path):
    (tmp_path / "z.csv").write_text("LocationID,Borough,Zone,service_zone\n1,B,\"Z, one\",s\n2,,Y,s\n")
    rows = read_lookup_csv(spark, str(tmp_path / "z.csv"), ZONE_SCHEMA).collect()
    assert [tuple(r) for r in rows] == [(1, "B", "Z, one", "s"), (2, None, "Y", "s")]


def test_lookup_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "z.csv").write_text("Borough,LocationID,Zone,service_zone\nB,1,Z,s\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_lookup_csv(spark, str(tmp_path / "z.csv"), ZONE_SCHEMA).collect()


def test_text_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("one\n\ntwo words\n")
    assert [r.value for r in read_text_lines(spark, str(tmp_path / "t.txt")).collect()] == ["one", "", "two words"]


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    save_to_parquet(spark.range(5), path)
    save_to_parquet(spark.range(2), path, mode="append")
    assert load_from_parquet(spark, path).count() == 7
    save_to_parquet(spark.range(2), path)
    assert load_from_parquet(spark, path).count() == 2


def test_number_of_files_on_request(spark, tmp_path):
    save_to_parquet(spark.range(100, numPartitions=8), str(tmp_path / "one"), files=1)
    assert len(load_from_parquet(spark, str(tmp_path / "one")).inputFiles()) == 1


@pytest.mark.parametrize("rebalance", [True, False])
def test_partitioned_write(spark, tmp_path, rebalance):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    save_to_parquet(df, str(tmp_path / "t"), partition_by=["k"], rebalance=rebalance)
    assert {p.name for p in (tmp_path / "t").glob("k=*")} == {"k=0", "k=1", "k=2"}
    assert load_from_parquet(spark, str(tmp_path / "t")).filter("k = 1").count() == 33


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(4))
    assert staged.count() == 4
    assert all(shared_folder(spark) in f for f in staged.inputFiles())
    assert stage(spark.range(4)).inputFiles() != staged.inputFiles()


class Settings:
    """Stands for a session with the given settings only."""

    def __init__(self, **settings):
        self.conf = self
        self.get = lambda key, default=None: settings.get(key.replace(".", "_"), default)


def test_the_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(Settings(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")) == "hdfs:///shared"
    assert shared_folder(Settings(spark_sql_warehouse_dir="hdfs:///warehouse", spark_master="yarn")) == "hdfs:///warehouse"
    assert shared_folder(Settings(spark_sql_warehouse_dir="file:/warehouse", spark_master="local[2]")) == "file:/warehouse"
    for local in ("file:/warehouse", "/warehouse"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(Settings(spark_sql_warehouse_dir=local, spark_master="yarn"))


def test_staged_tables_can_be_deleted(spark):
    staged = stage(spark.range(4))
    folder = Path(staged.inputFiles()[0].removeprefix("file://")).parent
    assert folder.is_dir()
    drop_staged(staged)
    assert not folder.exists()
    drop_folder(spark, str(folder))


def test_shuffles_grow_with_the_input_and_never_shrink(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, SF_DIR) == int(before)
        monkeypatch.setattr(session, "PARTITION_BYTES", 100_000)
        grown = session.size_shuffles(spark, SF_DIR)
        assert int(before) < grown == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert session.size_shuffles(spark, SF_DIR, partition_bytes=10**12) == grown
        assert session.size_shuffles(spark, SF_DIR, partition_bytes=1000) > 100 * grown // 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_schema_report(spark):
    df = spark.createDataFrame([], "a int, b timestamp_ntz, X string")
    report = {r.field: tuple(r)[1:] for r in validate_schema(df, StructType.fromDDL("a long, b timestamp, x string")).collect()}
    assert report == {
        "a": ("type_mismatch", "bigint", "int"),
        "b": ("type_mismatch", "timestamp", "timestamp_ntz"),
        "x": ("missing", "string", None),
        "X": ("extra", None, "string"),
    }
    assert not is_valid(df, StructType.fromDDL("a int, b timestamp, X string"))
    assert is_valid(df, StructType.fromDDL("X string, b timestamp, a int"), treat_ntz_as_timestamp=True)


def test_conforming_to_a_schema(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a int, gone string, `c.d` double")
    declared = StructType.fromDDL("`c.d` string, a long")
    assert [tuple(r) for r in conform(df, declared).collect()] == [("2.5", 1)]
    with pytest.raises(ValueError, match="missing"):
        conform(df, StructType.fromDDL("a long, missing string"))


def test_feed_names(spark):
    raw = spark.createDataFrame([], YELLOW_SCHEMA)
    assert standardize_column_names(raw, "Yellow").columns[1:3] == ["pickup_datetime", "dropoff_datetime"]
    green = spark.createDataFrame([], GREEN_SCHEMA)
    assert standardize_column_names(green, "GREEN").columns[1:3] == ["pickup_datetime", "dropoff_datetime"]
    assert standardize_column_names(raw, "other").columns == raw.columns


def test_lineage_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert add_metadata_columns(df, "yellow").columns == ["id", "taxi_type", "processed_timestamp"]
    assert add_metadata_columns(df, "yellow", "f.parquet").first().source_file == "f.parquet"
    tracked = add_metadata_columns(df, "yellow", F.col("_metadata.file_path"))
    assert {r.source_file for r in tracked.collect()} <= set(df.inputFiles()) | {
        f.replace("file:///", "file:/") for f in df.inputFiles()
    }


def test_combining_keeps_common_columns_in_the_first_order(spark):
    a = spark.createDataFrame([(1, 2, 3), (1, 2, 3)], "x int, y int, Fee int")
    b = spark.createDataFrame([(20, 10, 5)], "y int, x int, fee int")
    assert column_overlap(a, b) == {"common": ["x", "y"], "left_only": ["Fee"], "right_only": ["fee"]}
    both = combine_feeds(a, b)
    assert both.columns == ["x", "y"]
    assert sorted(map(tuple, both.collect())) == [(1, 2), (1, 2), (10, 20)]


def test_layers_round_trip(spark, tmp_path):
    layout = Layout(str(tmp_path))
    trips = stage(delivered_trips(spark, SF_DIR))
    feeds = {feed: as_feed(trips, feed) for feed in FEEDS}
    assert all(is_valid(df, FEED_SCHEMAS[f], treat_ntz_as_timestamp=True) for f, df in feeds.items())
    build_bronze(layout, feeds, zone_lookup(spark, SF_DIR))
    build_silver(spark, layout, FEEDS)
    build_gold(spark, layout, FEEDS)

    bronze = {f: load_from_parquet(spark, layout.bronze(f)) for f in FEEDS}
    silver = {f: load_from_parquet(spark, layout.silver(f)) for f in FEEDS}
    gold = load_from_parquet(spark, layout.gold("combined_taxi_data"))
    assert sum(df.count() for df in bronze.values()) == trips.count()
    assert all(len(df.columns) == 22 for df in bronze.values())
    assert all(len(df.columns) == 31 for df in silver.values())
    assert len(gold.columns) == 29
    assert gold.count() == sum(df.count() for df in silver.values())
    for table in ("zone_analytics", "time_analytics"):
        total = load_from_parquet(spark, layout.gold(table)).agg(F.sum("total_trips")).first()[0]
        assert total == gold.count()


def test_silver_by_month_gives_the_same_gold(spark, tmp_path, plan):
    trips = stage(delivered_trips(spark, SF_DIR))
    totals = []
    for name, months in (("plain", ()), ("monthly", ("pickup_year", "pickup_month"))):
        layout = Layout(str(tmp_path / name))
        build_bronze(layout, {"green": as_feed(trips, "green")}, zone_lookup(spark, SF_DIR))
        build_silver(spark, layout, ["green"], partition_by=months)
        build_gold(spark, layout, ["green"])
        time = load_from_parquet(spark, layout.gold("time_analytics"))
        totals.append(sorted(time.select("pickup_year", "pickup_month", "pickup_hour", "is_weekend", "total_trips").collect()))
    assert totals[0] == totals[1]
    assert (tmp_path / "monthly/silver/green_taxi/pickup_year=1995").exists()
    january = load_from_parquet(spark, layout.silver("green")).filter("pickup_year = 1995 AND pickup_month = 1")
    assert "PartitionFilters: [isnotnull(pickup_year" in plan(january)


def test_an_absent_feed_is_skipped(spark, tmp_path):
    layout = Layout(str(tmp_path))
    build_bronze(layout, {"green": as_feed(delivered_trips(spark, SF_DIR), "green")}, zone_lookup(spark, SF_DIR))
    build_silver(spark, layout, ["green"])
    build_gold(spark, layout, ["green"])
    assert load_from_parquet(spark, layout.gold("combined_taxi_data")).select("taxi_type").distinct().count() == 1


def test_layers_from_delivered_files(spark, tmp_path):
    trips = stage(delivered_trips(spark, SF_DIR))
    yellow = as_feed(trips, "yellow")
    raw = tmp_path / "raw"
    half = F.col("VendorID") == 1
    drifted = yellow.withColumn("passenger_count", F.col("passenger_count").cast("double"))
    save_to_parquet(yellow.filter(half), f"{raw}/taxi/yellow_tripdata_2025-01.parquet")
    save_to_parquet(drifted.filter(~half), f"{raw}/taxi/yellow_tripdata_2025-02.parquet")
    zones = zone_lookup(spark, SF_DIR).coalesce(1).write.option("header", True)
    zones.csv(f"{raw}/lookup/taxi_zone_lookup.csv")

    layout = run(spark, str(raw), str(tmp_path / "out"), drifted=True)
    bronze = load_from_parquet(spark, layout.bronze("yellow"))
    assert bronze.count() == yellow.count()
    assert dict(bronze.dtypes)["passenger_count"] == "bigint"
    gold = load_from_parquet(spark, layout.gold("zone_analytics"))
    silver = load_from_parquet(spark, layout.silver("yellow"))
    assert gold.agg(F.sum("total_trips")).first()[0] == silver.count() > 0
    assert not (tmp_path / "out/silver/green_taxi").exists()


def raw_files(spark, tmp_path):
    """A raw folder of two years' deliveries, the first without a column, and the zone lookup."""
    trips = stage(delivered_trips(spark, SF_DIR))
    yellow, raw = as_feed(trips, "yellow"), tmp_path / "raw"
    half = F.col("VendorID") == 1
    save_to_parquet(yellow.filter(half).drop("Airport_fee"), f"{raw}/taxi/yellow_tripdata_2019-12.parquet")
    save_to_parquet(yellow.filter(~half), f"{raw}/taxi/yellow_tripdata_2025-01.parquet")
    zone_lookup(spark, SF_DIR).coalesce(1).write.option("header", True).csv(f"{raw}/lookup/taxi_zone_lookup.csv")
    return yellow, raw


def test_deliveries_of_all_years_and_columns_with_their_files(spark, tmp_path):
    yellow, raw = raw_files(spark, tmp_path)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {p for p in folder.glob("fareloom-*/prepared*")}
    layout = run(spark, str(raw), str(tmp_path / "out"), partition_by=["pickup_year"], source_files=True)
    bronze = load_from_parquet(spark, layout.bronze("yellow"))
    assert bronze.count() == yellow.count() and bronze.columns[-1] == "source_file"
    assert bronze.filter("Airport_fee IS NULL").count() == yellow.filter("VendorID = 1").count()
    files = bronze.select(F.regexp_extract("source_file", "tripdata_([0-9-]+)", 1).alias("f")).distinct().collect()
    assert {r.f for r in files} == {"2019-12", "2025-01"}
    assert list((tmp_path / "out/silver/yellow_taxi").glob("pickup_year=*"))
    assert {p for p in folder.glob("fareloom-*/prepared*")} == before
    drifted = run(spark, str(raw), str(tmp_path / "drifted"), drifted=True, source_files=True)
    assert load_from_parquet(spark, drifted.bronze("yellow")).filter("source_file IS NULL").count() == 0
    one = run(spark, str(raw), str(tmp_path / "one"), patterns={"yellow": "taxi/yellow_tripdata_2025-*.parquet"})
    assert load_from_parquet(spark, one.bronze("yellow")).count() == yellow.filter("VendorID <> 1").count()


def test_conflicting_types_are_an_error_by_default(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a_1.parquet")
    spark.range(3).selectExpr("string(id) AS id").write.parquet(f"{tmp_path}/a_2.parquet")
    with pytest.raises(Exception, match="MERGE"):
        medallion.raw_feeds(spark, str(tmp_path), {"a": "a_*.parquet"})


def test_many_deliveries_of_two_schemas_take_few_jobs(spark, tmp_path):
    paths = [f"{tmp_path}/d_{k:02}.parquet" for k in range(50)]
    for k, path in enumerate(paths):
        kind = "double" if k < 23 else "long"
        spark.range(k, k + 1).selectExpr(f"cast(id AS {kind}) AS id", *(["1 AS extra"] if k % 3 else [])).coalesce(1).write.parquet(path)
    schema = StructType.fromDDL("id long, extra int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    df = read_deliveries(spark, paths, schema)
    jobs = len(tracker.getJobIdsForGroup("footers"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 16
    assert sorted(map(tuple, df.collect())) == [(k, 1 if k % 3 else None) for k in range(50)]


def test_a_hot_key_is_split_over_the_files_asked_for(spark, tmp_path):
    df = spark.range(10_000).withColumn("k", F.lit(1))
    save_to_parquet(df, str(tmp_path / "t"), partition_by=["k"], files=4)
    assert len(list((tmp_path / "t/k=1").glob("*.parquet"))) == 4
    save_to_parquet(df.withColumn("k", F.col("id") % 50), str(tmp_path / "u"), partition_by=["k"], files=4)
    assert len(list((tmp_path / "u").glob("k=*/*.parquet"))) <= 54


def test_nothing_delivered_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no deliveries"):
        run(spark, str(tmp_path), str(tmp_path / "out"))


def test_a_key_with_a_third_of_the_rows_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1))
        save_to_parquet(df, str(tmp_path / "t"), partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "k=0").glob("*.parquet"))) > 1
    assert load_from_parquet(spark, str(tmp_path / "t")).count() == 200_000


def test_wordcount_job(spark, tmp_path, capfd):
    (tmp_path / "t.txt").write_text("b a b\n")
    main(["wordcount", str(tmp_path / "t.txt"), "-k", "1"])
    assert "|b   |2    |" in capfd.readouterr().out
