"""Every operator as a query over the order, document and embedding tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators import aggregates, cleaning, feeds, outliers, quality, statistics, text
from fareloom.operators.features import add_derived_features
from fareloom.operators.quantiles import exact_quantiles
from fareloom.operators.ratios import hit_rate, inside_circle
from fareloom.plans import medallion, sample_layers, sample_trips
from fareloom.plans.sample_trips import FEEDS
from fareloom.session import size_shuffles
from fareloom.sources import readers
from fareloom.sources.footers import file_order
from fareloom.sources.schema_checks import conform, validate_deliveries, validate_schema
from fareloom.sources.schemas import FEED_SCHEMAS, PROCESSED_AT, SOURCE_FILE, ZONE_SCHEMA, declared
from fareloom.sources.sinks import new_folder, save_to_parquet, stage

Query = Callable[[SparkSession, str], DataFrame]

# Two engines add floating-point numbers in different orders: results of averaging and
# summing are compared at this many places.
MEAN_PLACES = 4
SUM_PLACES = 2


def rounded(df: DataFrame, *columns: str, places: int = MEAN_PLACES) -> DataFrame:
    """Round for comparison; values half-way between two results are nudged off the middle."""
    nudge = 1e-6 if places == SUM_PLACES else 1e-9
    return df.withColumns({c: F.round(F.col(c) + F.lit(nudge), places) for c in columns})


def _means_and_revenue(df: DataFrame) -> DataFrame:
    """Round the averages, and the revenue as a sum, of an aggregate table."""
    means = [c for c in df.columns if c.startswith("avg_")]
    sums = [c for c in df.columns if c == "total_revenue"]
    return rounded(rounded(df, *means), *sums, places=SUM_PLACES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.load_from_parquet(spark, f"{sf_dir}/{name}.parquet")


def _bronze(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return readers.load_from_parquet(
        spark, sample_layers.bronze_layout(spark, sf_dir).bronze(feed)
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = sample_layers.silver_layout(spark, sf_dir)
    return medallion.combined(spark, layout, FEEDS)


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.load_from_parquet(spark, sample_layers.bronze_layout(spark, sf_dir).zones())


def _per_feed(
    table: Callable[[SparkSession, str, str], DataFrame], report: Callable[[DataFrame], DataFrame]
) -> Query:
    """A report on each feed, with the feed it is about in ``taxi_type``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reduce(
            DataFrame.unionByName,
            (
                report(table(spark, sf_dir, feed)).withColumn("taxi_type", F.lit(feed))
                for feed in FEEDS
            ),
        )

    return query


def _trips(
    table: Callable[[SparkSession, str, str], DataFrame], step: Callable[[DataFrame], DataFrame]
) -> Query:
    """Rows of all feeds after a step, without the load time, which differs from run to run."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        shown = [step(table(spark, sf_dir, feed)) for feed in FEEDS]
        return feeds.combine_feeds(*shown).drop(PROCESSED_AT)

    return query


def _on_silver(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _means_and_revenue(report(_silver(spark, sf_dir)))


def _on_zones(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _means_and_revenue(
        report(aggregates.zone_totals(_silver(spark, sf_dir), _zones(spark, sf_dir)))
    )


def standardized_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = ((sample_layers.raw_feed(spark, sf_dir, feed), feed) for feed in FEEDS)
    return feeds.combine_feeds(*(medallion.ingest(df, feed) for df, feed in raw)).drop(PROCESSED_AT)


def source_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per feed folder, from the source file recorded with every row."""
    files = readers.load_from_parquet(spark, f"{sample_layers.delivered(spark, sf_dir)}/feed=*")
    tagged = feeds.add_metadata_columns(files, "any", file_path=F.col("_metadata.file_path"))
    folder = F.regexp_extract("source_file", "feed=([a-z]+)/", 1)
    return tagged.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


def clean_rejects(df: DataFrame) -> DataFrame:
    rejects = cleaning.rejected_trips(df)
    return rejects.withColumn("failed_rules", F.array_join("failed_rules", ","))


def iqr_bounds(df: DataFrame) -> DataFrame:
    bounds = outliers.fit_bounds(df)
    return rounded(
        outliers.bounds_table(df.sparkSession, bounds), "q1", "q3", "lower_bound", "upper_bound", places=6
    )


def outlier_audit(df: DataFrame) -> DataFrame:
    return rounded(outliers.outlier_audit(df, outliers.fit_bounds(df)), "pct_removed")


def zscore_filter(df: DataFrame) -> DataFrame:
    return outliers.remove_outliers(df, method="zscore", staged=True)


def summary_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each feed and of both together."""
    tables = {feed: sample_layers.silver_feed(spark, sf_dir, feed) for feed in FEEDS}
    tables["combined"] = _silver(spark, sf_dir)
    totals = (statistics.summary_totals(df, name) for name, df in tables.items())
    return _means_and_revenue(reduce(DataFrame.unionByName, totals))


def summary_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics of each feed and of both together."""
    tables = {feed: sample_layers.silver_feed(spark, sf_dir, feed) for feed in FEEDS}
    tables["combined"] = _silver(spark, sf_dir)
    reports = (statistics.summary_statistics(df).withColumn("taxi_type", F.lit(name)) for name, df in tables.items())
    return rounded(reduce(DataFrame.unionByName, reports), "mean", "stddev", "min", "max", "median")


def _stored_layers(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], DataFrame]:
    layout = sample_layers.gold_layout(spark, sf_dir)
    paths = {("bronze", feed): layout.bronze(feed) for feed in FEEDS}
    paths |= {("silver", feed): layout.silver(feed) for feed in FEEDS}
    paths[("gold", "combined")] = layout.gold("combined_taxi_data")
    return {key: readers.load_from_parquet(spark, path) for key, path in paths.items()}


def _gold(table: str) -> Query:
    """A table as it was stored in the gold layer."""
    return lambda spark, sf_dir: readers.load_from_parquet(
        spark, sample_layers.gold_layout(spark, sf_dir).gold(table)
    )


def _stored_gold(table: str) -> Query:
    """An aggregate of the gold layer, rounded."""
    return lambda spark, sf_dir: _means_and_revenue(_gold(table)(spark, sf_dir))


def schema_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered green columns against the declared yellow ones, with the NULLs found in each."""
    green = sample_layers.raw_feed(spark, sf_dir, "green")
    report = validate_schema(green, FEED_SCHEMAS["yellow"], treat_ntz_as_timestamp=True)
    nulls = quality.null_profile(green).select(F.col("column_name").alias("field"), "null_count")
    return report.join(nulls, "field", "left").withColumn(
        "actual", F.regexp_replace("actual", "_ntz$", "")
    )


DECLARED_ORDER = declared(
    {"o_orderkey": "long", "o_custkey": "long", "o_totalprice": "double", "o_clerk": "string"}
)


def enforced_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a narrower key than declared, undeclared columns and a declared one missing."""
    narrow = _table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("int"))
    return conform(narrow, DECLARED_ORDER, require_all=False)


def _drifted_orders(spark: SparkSession, sf_dir: str) -> list[str]:
    """Folders of orders delivered by status with other key types and, for one, a column short."""
    orders = _table(spark, sf_dir, "orders")
    finished = orders.filter("o_orderstatus = 'F'").withColumn(
        "o_custkey", F.col("o_custkey").cast("double")
    )
    others = orders.filter("NOT (o_orderstatus <=> 'F')").drop("o_totalprice").withColumn(
        "o_custkey", F.col("o_custkey").cast("int")
    )
    paths = []
    for name, delivery in (("finished", finished), ("others", others)):
        paths.append(new_folder(spark, name))
        save_to_parquet(delivery, paths[-1])
    return paths


def drifted_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifted orders under the declared schema."""
    return readers.read_deliveries(spark, _drifted_orders(spark, sf_dir), DECLARED_ORDER)


def drifted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each delivery of drifted orders departs from the declared schema, and for how many rows."""
    paths = _drifted_orders(spark, sf_dir)
    report = validate_deliveries(spark, paths, DECLARED_ORDER)
    delivery = F.element_at(F.split("file", "/"), -2).alias("delivery")
    # A row count a file, from the footers; names alone are compared, as schemes are written in several ways.
    counts = reduce(DataFrame.unionByName, (readers.file_row_counts(readers.load_from_parquet(spark, p)) for p in paths))
    named = counts.select(F.element_at(F.split("file_path", "/"), -1).alias("name"), "n_rows")
    joined = report.withColumn("name", F.element_at(F.split("file", "/"), -1)).join(named, "name")
    shown = joined.withColumn("actual", F.regexp_replace("actual", "_ntz$", ""))
    return shown.groupBy(delivery, "field", "status", "expected", "actual").agg(F.sum("n_rows").alias("n_rows"))


def _positions(stored: Callable[[SparkSession, str], DataFrame], *keys: str) -> Query:
    """The keys of a sorted table with the position each row was stored at."""
    return lambda spark, sf_dir: file_order(stored(spark, sf_dir)).select(*keys, "position")


def merged_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders delivered in two years, one a column short, as the layers read them by default."""
    orders = _table(spark, sf_dir, "orders")
    folder = new_folder(spark, "raw")
    even = F.col("o_orderkey") % 2 == 0
    save_to_parquet(orders.filter(even), f"{folder}/orders_2024-12.parquet")
    save_to_parquet(orders.filter(~even).drop("o_totalprice"), f"{folder}/orders_2025-01.parquet")
    return medallion.raw_feeds(spark, folder, {"orders": "orders_*.parquet"})["orders"].select(*orders.columns)


def dedup_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items loaded twice from two files: each kept row has the lineage of one of its copies."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    late = (F.col("l_orderkey") % 2).cast("int")
    loads = (
        lines.select("*", F.timestamp_seconds(F.lit(86400) * (late + 1)).alias(PROCESSED_AT), F.lit("a").alias(SOURCE_FILE)),
        lines.select("*", F.timestamp_seconds(F.lit(86400) * (2 - late)).alias(PROCESSED_AT), F.lit("b").alias(SOURCE_FILE)),
    )
    kept = cleaning.drop_duplicates(reduce(DataFrame.unionByName, loads))
    return kept.withColumn(PROCESSED_AT, F.unix_timestamp(PROCESSED_AT))


def nan_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of a price that is NaN in a seventh and NULL in an eleventh of the rows."""
    key = F.col("l_partkey")
    price = F.when(key % 11 == 0, None).when(key % 7 == 0, float("nan")).otherwise(F.col("l_extendedprice"))
    points = [0.1, 0.25, 0.5, 0.75, 0.95]
    found = exact_quantiles(_table(spark, sf_dir, "lineitem").select(price.alias("price")), {"price": points})["price"]
    rows = [(p, v != v, None if v != v else v) for p, v in zip(points, found, strict=True) if v is not None]
    return spark.createDataFrame(rows, "p double, is_nan boolean, value double")


def zone_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup against its declared schema."""
    return validate_schema(_zones(spark, sf_dir), ZONE_SCHEMA)


def zone_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.quality_report(_zones(spark, sf_dir)), "value")


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_table(spark, sf_dir, "orders"), "orders")


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "orders_by_status")
    orders = _table(spark, sf_dir, "orders")
    save_to_parquet(orders, path, partition_by=["o_orderstatus"])
    return readers.load_from_parquet(spark, path).select(*orders.columns)


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written, then appended once more, counted by status."""
    path = new_folder(spark, "orders_twice")
    orders = _table(spark, sf_dir, "orders")
    save_to_parquet(orders, path)
    save_to_parquet(orders, path, mode="append")
    return (
        readers.load_from_parquet(spark, path)
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def csv_lookup_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "zone_lookup_csv")
    sample_trips.zone_lookup(spark, sf_dir).write.option("header", True).csv(path)
    return readers.read_lookup_csv(spark, path, ZONE_SCHEMA)


def text_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, written as text files and read back, with how often each occurs."""
    path = new_folder(spark, "document_lines")
    _table(spark, sf_dir, "documents").select("text").write.text(path)
    return readers.read_text_lines(spark, path).groupBy("value").agg(
        F.count(F.lit(1)).alias("n_lines")
    )


def glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table, from one scan over all files that match a pattern."""
    files = readers.read_parquet(spark, f"{sf_dir}/*.parquet")
    name = F.regexp_extract("file_path", r"/([^/]+)\.parquet", 1)
    return (
        readers.file_row_counts(files)
        .groupBy(name.alias("table_name"))
        .agg(F.sum("n_rows").alias("n_rows"))
    )


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(_table(spark, sf_dir, "documents"), "text")


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.top_words(_table(spark, sf_dir, "documents"), column="text")


def circle_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of vectors whose first two components lie in a circle, times four."""

    def component(i: int) -> Column:
        return F.col("embedding")[i].cast("double")

    hits = inside_circle(component(0), component(1), radius_squared=0.01)
    return rounded(hit_rate(_table(spark, sf_dir, "embeddings"), hits, scale=4.0), "estimate", places=6)


def zone_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = aggregates.join_pickup_zone(_silver(spark, sf_dir), _zones(spark, sf_dir))
    return joined.select(
        "PULocationID", "pickup_borough", "pickup_zone", "pickup_datetime", "total_amount"
    )


def time_rollup(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_silver(lambda df: report(aggregates.time_totals(df)))


_sized: set[tuple[str, str]] = set()


def _with_shuffles_sized(query: Query) -> Query:
    """The query, after the session's shuffles were sized for the tables, once per folder."""

    def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _sized:
            size_shuffles(spark, sf_dir)
            _sized.add(key)
        return query(spark, sf_dir)

    return sized


def queries() -> dict[str, Query]:
    """All registered queries by name; each takes a session and the folder of the tables."""
    return {name: _with_shuffles_sized(query) for name, query in _registered().items()}


def _registered() -> dict[str, Query]:
    prepared = sample_layers.prepared
    silver_feed = sample_layers.silver_feed
    return {
        # scans, sources, sinks, schemas
        "glob_scan": glob_scan,
        "csv_lookup_scan": csv_lookup_scan,
        "text_line_scan": text_line_scan,
        "parquet_roundtrip": parquet_roundtrip,
        "partitioned_roundtrip": partitioned_roundtrip,
        "append_roundtrip": append_roundtrip,
        "drifted_deliveries": drifted_deliveries,
        "drifted_fields": drifted_fields,
        "merged_deliveries": merged_deliveries,
        "enforced_schema": enforced_schema,
        "schema_comparison": schema_comparison,
        "zone_schema": zone_schema,
        "zone_quality": zone_quality,
        # bronze
        "standardized_feed": standardized_feed,
        "source_file_rows": source_file_rows,
        "table_shape": _per_feed(_bronze, statistics.table_shape),
        "describe_numeric": _per_feed(
            _bronze, lambda df: rounded(statistics.describe_numeric(df), "mean", "stddev", "min", "max")
        ),
        "date_range": _per_feed(_bronze, statistics.date_range),
        "null_profile": _per_feed(
            _bronze, lambda df: rounded(quality.null_profile(df), "null_percentage")
        ),
        "null_summary": _per_feed(
            _bronze, lambda df: rounded(quality.null_summary(df), "null_percentage")
        ),
        "duplicate_profile": _per_feed(
            _bronze, lambda df: rounded(quality.duplicate_profile(df), "duplicate_percentage")
        ),
        "quality_report": _per_feed(
            _bronze, lambda df: rounded(quality.quality_report(df), "value")
        ),
        "invalid_value_checks": _per_feed(_bronze, quality.invalid_values),
        # silver
        "dedup_rows": _trips(_bronze, cleaning.drop_duplicates),
        "dedup_lineage": dedup_lineage,
        "nan_quantiles": nan_quantiles,
        "clean_rows": _trips(_bronze, cleaning.clean_trips),
        "clean_audit": _per_feed(
            _bronze, lambda df: rounded(cleaning.cleaning_audit(df), "pct_removed")
        ),
        "clean_rejects": _trips(_bronze, clean_rejects),
        "rule_failures": _per_feed(_bronze, cleaning.rule_failures),
        "derived_features": _trips(_bronze, add_derived_features),
        "iqr_bounds": _per_feed(prepared, iqr_bounds),
        "iqr_filter": _trips(prepared, lambda df: outliers.remove_outliers(df, staged=True)),
        "outlier_audit": _per_feed(prepared, outlier_audit),
        "zscore_filter": _trips(prepared, zscore_filter),
        "layer_counts": lambda spark, sf_dir: quality.row_counts(_stored_layers(spark, sf_dir)),
        "layer_reduction": lambda spark, sf_dir: rounded(
            quality.layer_reduction(quality.row_counts(_stored_layers(spark, sf_dir))), "pct_removed"
        ),
        # gold
        "combined_feeds": _trips(silver_feed, lambda df: df),
        "feed_distribution": _on_silver(aggregates.feed_distribution),
        "zone_join": zone_join,
        "zone_aggregate": lambda spark, sf_dir: _means_and_revenue(
            aggregates.aggregate_by_zone(_silver(spark, sf_dir), _zones(spark, sf_dir))
        ),
        "top_zones": _on_zones(aggregates.top_zones),
        "borough_rollup": _on_zones(lambda df: aggregates.borough_rollup(df, weighted=True)),
        "time_aggregate": _on_silver(aggregates.aggregate_by_time),
        "hourly_pattern": time_rollup(lambda df: aggregates.hourly_pattern(df, weighted=True)),
        "weekend_pattern": time_rollup(lambda df: aggregates.weekend_pattern(df, weighted=True)),
        "monthly_trend": time_rollup(aggregates.monthly_trend),
        "stored_zone_analytics": _stored_gold("zone_analytics"),
        "stored_time_analytics": _stored_gold("time_analytics"),
        "zone_order": _positions(_gold("zone_analytics"), "PULocationID", "total_trips"),
        "time_order": _positions(
            _gold("time_analytics"), "pickup_year", "pickup_month", "pickup_hour", "is_weekend"
        ),
        "feed_order": _positions(
            lambda spark, sf_dir: stage(aggregates.feed_distribution(_silver(spark, sf_dir)), "feeds"), "taxi_type"
        ),
        "payment_analysis": _on_silver(aggregates.payment_analysis),
        "fleet_kpis": lambda spark, sf_dir: rounded(
            _means_and_revenue(aggregates.fleet_kpis(_silver(spark, sf_dir))), "revenue_per_minute"
        ),
        "summary_statistics": summary_statistics,
        "summary_totals": summary_totals,
        "busiest_hour": _on_silver(lambda df: statistics.busiest(df, "pickup_hour")),
        "busiest_day": _on_silver(lambda df: statistics.busiest(df, "pickup_day_of_week")),
        "od_pairs": _on_silver(aggregates.popular_pairs),
        "revenue_by_feed": _on_silver(aggregates.revenue_by_feed),
        "trips_per_hour": lambda spark, sf_dir: rounded(
            aggregates.trips_per_hour(_silver(spark, sf_dir)), "trips_per_hour"
        ),
        "revenue_per_trip": lambda spark, sf_dir: rounded(
            aggregates.revenue_per_trip(_silver(spark, sf_dir)), "revenue_per_trip"
        ),
        "distance_efficiency": lambda spark, sf_dir: rounded(
            aggregates.distance_efficiency(_silver(spark, sf_dir)), "revenue_per_mile"
        ),
        "revenue_share": lambda spark, sf_dir: rounded(
            _means_and_revenue(aggregates.revenue_share(_silver(spark, sf_dir))),
            "revenue_share",
            places=6,
        ),
        # text and ratios
        "word_count": word_count,
        "top_words": top_words,
        "hit_rate": circle_hit_rate,
    }
