"""The registered queries once more, as SQL for an independent engine.

Each statement starts from the given tables and repeats the whole chain in SQL, so it shares
no intermediate result with the Spark queries. Only the expressions that define the
sample trips are common text.
"""

from fareloom.plans.sample_trips import DROPOFF, FEED_ONLY, FEEDS, TOTAL_AMOUNT, TRIP_EXPRESSIONS

SHARED = [
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
]
DERIVED = [
    "trip_duration_minutes",
    "average_speed_mph",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_month",
    "pickup_year",
    "time_period",
    "is_weekend",
    "tip_rate",
]
BRONZE_COLUMNS = ", ".join([*SHARED, "taxi_type"])
SILVER_COLUMNS = ", ".join([*SHARED, "taxi_type", *DERIVED])

_EXPRESSIONS = ", ".join(f"{sql} AS {name}" for name, sql in TRIP_EXPRESSIONS.items())

# Each step reads the one above it.
STEPS = {
    "one_each": f"""
        SELECT {_EXPRESSIONS} FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey""",
    "with_ends": f"SELECT *, {TOTAL_AMOUNT} AS total_amount, {DROPOFF} AS dropoff_datetime FROM one_each",
    "bronze": f"""
        SELECT {BRONZE_COLUMNS} FROM (
            SELECT *, feed AS taxi_type FROM with_ends
            UNION ALL
            SELECT *, feed AS taxi_type FROM with_ends WHERE copies = 2)""",
    "deduped": "SELECT DISTINCT * FROM bronze",
}

RULES = {
    "pickup_datetime_present": "pickup_datetime IS NOT NULL",
    "dropoff_datetime_present": "dropoff_datetime IS NOT NULL",
    "times_in_order": "pickup_datetime < dropoff_datetime",
    "trip_distance_in_range": "trip_distance BETWEEN 0 AND 1000",
    "passenger_count_in_range": "passenger_count BETWEEN 1 AND 8",
    "fare_amount_in_range": "fare_amount BETWEEN 0 AND 1000",
    "total_amount_in_range": "total_amount BETWEEN 0 AND 1000",
    "PULocationID_present": "PULocationID IS NOT NULL",
    "DOLocationID_present": "DOLocationID IS NOT NULL",
    "places_differ": "PULocationID <> DOLocationID",
}
KEEP = " AND ".join(f"({rule})" for rule in RULES.values())

_FEATURES = """
    SELECT *,
        CASE WHEN trip_duration_minutes > 0
             THEN trip_distance / trip_duration_minutes * 60 ELSE 0.0::DOUBLE END AS average_speed_mph,
        CASE WHEN pickup_hour >= 6 AND pickup_hour < 12 THEN 'Morning'
             WHEN pickup_hour >= 12 AND pickup_hour < 18 THEN 'Afternoon'
             WHEN pickup_hour >= 18 AND pickup_hour < 22 THEN 'Evening'
             ELSE 'Night' END AS time_period,
        coalesce(pickup_day_of_week IN (1, 7), false) AS is_weekend,
        CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0::DOUBLE END AS tip_rate
    FROM (
        SELECT *,
            (floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 60 AS trip_duration_minutes,
            hour(pickup_datetime)::INT AS pickup_hour,
            (dayofweek(pickup_datetime) + 1)::INT AS pickup_day_of_week,
            month(pickup_datetime)::INT AS pickup_month,
            year(pickup_datetime)::INT AS pickup_year
        FROM {source})"""

STEPS["cleaned"] = f"SELECT * FROM deduped WHERE {KEEP}"
STEPS["prepared"] = _FEATURES.format(source="cleaned")

OUTLIER_COLUMNS = ["trip_distance", "trip_duration_minutes", "fare_amount", "total_amount"]
_before = "prepared"
for _step, _column in enumerate(OUTLIER_COLUMNS, 1):
    STEPS[f"bounds{_step}"] = f"""
        SELECT taxi_type, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
        FROM (SELECT taxi_type, quantile_disc({_column}, 0.25) AS q1, quantile_disc({_column}, 0.75) AS q3
              FROM {_before} GROUP BY taxi_type)"""
    STEPS[f"kept{_step}"] = f"""
        SELECT t.* FROM {_before} t JOIN bounds{_step} b ON t.taxi_type = b.taxi_type
        WHERE {_column} BETWEEN lower_bound AND upper_bound"""
    _before = f"kept{_step}"
STEPS["silver"] = f"SELECT {SILVER_COLUMNS} FROM kept4"

STEPS["zones"] = """
    SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Z' AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey"""
STEPS["trips_in_zones"] = """
    SELECT s.*, Borough AS pickup_borough, Zone AS pickup_zone
    FROM silver s LEFT JOIN zones ON PULocationID = LocationID"""

_TIME_AVERAGES = """
    avg(trip_distance) AS avg_trip_distance, avg(trip_duration_minutes) AS avg_trip_duration,
    avg(fare_amount) AS avg_fare_amount, avg(total_amount) AS avg_total_amount,
    avg(passenger_count) AS avg_passenger_count"""
STEPS["zone_totals"] = f"""
    SELECT PULocationID, pickup_borough, pickup_zone, count(*) AS total_trips, {_TIME_AVERAGES},
           avg(tip_amount) AS avg_tip_amount, avg(tip_rate) AS avg_tip_rate,
           sum(total_amount) AS total_revenue
    FROM trips_in_zones GROUP BY ALL"""
STEPS["time_totals"] = f"""
    SELECT pickup_year, pickup_month, pickup_hour, time_period, is_weekend,
           count(*) AS total_trips, {_TIME_AVERAGES}, sum(total_amount) AS total_revenue
    FROM silver GROUP BY ALL"""


def _from(last: str, select: str) -> str:
    """A statement whose WITH clause holds every step up to ``last``."""
    names = list(STEPS)
    needed = names[: names.index(last) + 1]
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in needed)
    return f"WITH {ctes}\n{select}"


def _mean(column: str, name: str | None = None, places: int = 4) -> str:
    nudge = "1e-6" if places == 2 else "1e-9"
    return f"round({column} + {nudge}, {places}) AS {name or column}"


def _means(*columns: str) -> str:
    return ", ".join(_mean(c) for c in columns)


_TIME_MEANS = _means(
    "avg_trip_distance", "avg_trip_duration", "avg_fare_amount", "avg_total_amount", "avg_passenger_count"
)
_REVENUE = _mean("total_revenue", places=2)

# The columns of a stored bronze feed, feed-only ones included, with their types.
_FEED_TABLES = {
    feed: f"(SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in FEED_ONLY[feed].items())}"
    f" FROM bronze WHERE taxi_type = '{feed}')"
    for feed in FEEDS
}
_FEED_COLUMNS = {feed: [*SHARED, "taxi_type", *FEED_ONLY[feed]] for feed in FEEDS}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _null_profile(load_columns: tuple[str, ...]) -> str:
    rows = []
    for feed in FEEDS:
        for column in _FEED_COLUMNS[feed]:
            rows.append(
                f"SELECT '{feed}' AS taxi_type, '{column}' AS column_name,"
                f" count(*) - count({column}) AS null_count,"
                f" round((count(*) - count({column})) / count(*) * 100 + 1e-9, 4) AS null_percentage"
                f" FROM {_FEED_TABLES[feed]}"
            )
        rows += [
            f"SELECT '{feed}', '{column}', count(*) - count({column}),"
            f" round((count(*) - count({column})) / count(*) * 100 + 1e-9, 4)"
            f" FROM (SELECT *, now() AS {column} FROM {_FEED_TABLES[feed]})"
            for column in load_columns
        ]
    return _union(rows)


def _quality_report() -> str:
    rows = []
    for feed in FEEDS:
        table = _FEED_TABLES[feed]
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))"
        total = f"(SELECT count(*) FROM {table})"
        figures = {
            "total_rows": total,
            # The feed's columns and the load time.
            "total_columns": str(len(_FEED_COLUMNS[feed]) + 1),
            "duplicate_count": f"{total} - {distinct}",
            "duplicate_percentage": f"round(({total} - {distinct}) / {total} * 100 + 1e-9, 4)",
        }
        rows += [
            f"SELECT '{feed}' AS taxi_type, 'table' AS scope, '{metric}' AS metric, ({value})::DOUBLE AS value"
            for metric, value in figures.items()
        ]
        loaded = f"(SELECT *, now() AS processed_timestamp FROM {table})"
        for column in [*_FEED_COLUMNS[feed], "processed_timestamp"]:
            nulls = f"count(*) - count({column})"
            for metric, value in (
                ("null_count", nulls),
                ("null_percentage", f"round(({nulls}) / count(*) * 100 + 1e-9, 4)"),
            ):
                rows.append(
                    f"SELECT '{feed}', 'column:{column}', '{metric}', ({value})::DOUBLE FROM {loaded}"
                )
    return _union(rows)


def _zone_quality() -> str:
    zones = f"({STEPS['zones']})"
    total, distinct = f"(SELECT count(*) FROM {zones})", f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {zones}))"
    columns = ["LocationID", "Borough", "Zone", "service_zone"]
    figures = {
        "total_rows": total,
        "total_columns": str(len(columns)),
        "duplicate_count": f"{total} - {distinct}",
        "duplicate_percentage": f"round(({total} - {distinct}) / {total} * 100 + 1e-9, 4)",
    }
    rows = [
        f"SELECT 'table' AS scope, '{metric}' AS metric, ({value})::DOUBLE AS value"
        for metric, value in figures.items()
    ]
    for column in columns:
        nulls = f"count(*) - count({column})"
        rows.append(f"SELECT 'column:{column}', 'null_count', ({nulls})::DOUBLE FROM {zones}")
        rows.append(
            f"SELECT 'column:{column}', 'null_percentage', round(({nulls}) / count(*) * 100 + 1e-9, 4)::DOUBLE FROM {zones}"
        )
    return _union(rows)


# The reported checks and their limits, and the columns described and summarised.
_CHECKS = {
    "negative_distance": "trip_distance < 0",
    "negative_fare": "fare_amount < 0",
    "negative_total": "total_amount < 0",
    "invalid_passengers": "passenger_count <= 0",
    "invalid_times": "pickup_datetime >= dropoff_datetime",
}

_DESCRIBED = ["trip_distance", "fare_amount", "total_amount", "tip_amount", "passenger_count"]
_SUMMARISED = ["trip_distance", "trip_duration_minutes", "fare_amount", "total_amount", "tip_amount", "passenger_count"]


def _kept_and_removed(source: str, kept: str) -> str:
    return (
        f"SELECT taxi_type, rows_in, rows_kept, rows_in - rows_kept AS rows_removed,"
        f" round((rows_in - rows_kept) / rows_in * 100 + 1e-9, 4) AS pct_removed FROM"
        f" (SELECT taxi_type, count(*) AS rows_in FROM {source} GROUP BY taxi_type)"
        f" JOIN (SELECT taxi_type, count(*) AS rows_kept FROM {kept} GROUP BY taxi_type) USING (taxi_type)"
    )


_FAILED = (
    "concat_ws(',', "
    + ", ".join(f"CASE WHEN ({rule}) THEN NULL ELSE '{name}' END" for name, rule in RULES.items())
    + ")"
)

_LAYERS = """
    SELECT 'bronze' AS layer, taxi_type AS table_name, count(*) AS n_rows FROM bronze GROUP BY taxi_type
    UNION ALL SELECT 'silver', taxi_type, count(*) FROM silver GROUP BY taxi_type"""


def _top_1(key: str) -> str:
    return (
        f'SELECT {key}, count(*) AS "count" FROM silver GROUP BY {key}'
        f' ORDER BY "count" DESC, {key} NULLS FIRST LIMIT 1'
    )


def _summary_totals() -> str:
    def one(name: str, where: str) -> str:
        table = f"(SELECT * FROM silver {where})"

        def busiest(key: str) -> str:
            return f"(SELECT {key} FROM {table} GROUP BY {key} ORDER BY count(*) DESC, {key} LIMIT 1)"

        return (
            f"SELECT '{name}' AS taxi_type, count(*) AS total_trips,"
            f" round(sum(total_amount) + 1e-6, 2) AS total_revenue,"
            f" {busiest('pickup_hour')} AS busiest_hour,"
            f" {busiest('pickup_day_of_week')} AS busiest_day FROM {table}"
        )

    parts = [one(feed, f"WHERE taxi_type = '{feed}'") for feed in FEEDS]
    return _union([*parts, one("combined", "")])


def _zscore() -> dict[str, str]:
    steps, before = {}, "prepared"
    for step, column in enumerate(OUTLIER_COLUMNS, 1):
        steps[f"spread{step}"] = (
            f"SELECT taxi_type, avg({column}) AS mean, stddev_samp({column}) AS sd"
            f" FROM {before} GROUP BY taxi_type"
        )
        steps[f"near{step}"] = (
            f"SELECT t.* FROM {before} t JOIN spread{step} s ON t.taxi_type = s.taxi_type"
            f" WHERE {column} BETWEEN mean - 3 * sd AND mean + 3 * sd"
        )
        before = f"near{step}"
    return steps


_ZSCORE_STEPS = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in _zscore().items())

_YELLOW = """
    VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double"""


def _schema_comparison() -> str:
    """Green trips have all declared yellow columns but four, and four of their own."""
    own = {
        "lpep_pickup_datetime": ("timestamp", "pickup_datetime"),
        "lpep_dropoff_datetime": ("timestamp", "dropoff_datetime"),
        "ehail_fee": ("double", "ehail_fee"),
        "trip_type": ("bigint", "trip_type"),
    }
    rows = [
        f"SELECT '{name}', 'extra', NULL, '{kind}', count(*) - count({column}) FROM green"
        for name, (kind, column) in own.items()
    ]
    for name, kind in (field.split() for field in _YELLOW.split(",")):
        if name in SHARED:
            rows.append(f"SELECT '{name}', 'ok', '{kind}', '{kind}', count(*) - count({name}) FROM green")
        else:
            rows.append(f"SELECT '{name}', 'missing', '{kind}', NULL, NULL")
    return (
        f", green AS MATERIALIZED (SELECT * FROM {_FEED_TABLES['green']})"
        f" SELECT * FROM ({_union(rows)}) AS report(field, status, expected, actual, null_count)"
    )


TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def _weighted(column: str, name: str) -> str:
    return f"round(sum({column} * total_trips) / sum(total_trips) + 1e-9, 4) AS {name}_weighted"


_ZONE_AGGREGATE = (
    f"SELECT PULocationID, pickup_borough, pickup_zone, total_trips, {_TIME_MEANS},"
    f" {_means('avg_tip_amount', 'avg_tip_rate')}, {_REVENUE} FROM zone_totals"
)
_TIME_AGGREGATE = (
    "SELECT pickup_year, pickup_month, pickup_hour, time_period, is_weekend, total_trips,"
    f" {_TIME_MEANS}, {_REVENUE} FROM time_totals"
)


def oracle_sql() -> dict[str, str]:
    return {
        "glob_scan": _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES]),
        "csv_lookup_scan": f"SELECT * FROM ({STEPS['zones']})",
        "text_line_scan": """
            SELECT value, count(*) AS n_lines
            FROM (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM documents)
            GROUP BY value""",
        "parquet_roundtrip": "SELECT * FROM orders",
        "partitioned_roundtrip": "SELECT * FROM orders",
        "append_roundtrip": """
            SELECT o_orderstatus, count(*) AS n_rows
            FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders) GROUP BY o_orderstatus""",
        "drifted_deliveries": """
            SELECT o_orderkey, o_custkey,
                   CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
                   NULL::VARCHAR AS o_clerk
            FROM orders""",
        "drifted_fields": """
            SELECT delivery, field, status, expected, actual, n_rows
            FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'others' END AS delivery,
                         count(*) AS n_rows FROM orders GROUP BY 1)
            JOIN (VALUES
                ('finished', 'o_orderkey', 'ok', 'bigint', 'bigint'),
                ('finished', 'o_custkey', 'type_mismatch', 'bigint', 'double'),
                ('finished', 'o_totalprice', 'ok', 'double', 'double'),
                ('finished', 'o_clerk', 'missing', 'string', NULL),
                ('finished', 'o_orderstatus', 'extra', NULL, 'string'),
                ('finished', 'o_orderdate', 'extra', NULL, 'timestamp'),
                ('finished', 'o_orderpriority', 'extra', NULL, 'string'),
                ('others', 'o_orderkey', 'ok', 'bigint', 'bigint'),
                ('others', 'o_custkey', 'type_mismatch', 'bigint', 'int'),
                ('others', 'o_totalprice', 'missing', 'double', NULL),
                ('others', 'o_clerk', 'missing', 'string', NULL),
                ('others', 'o_orderstatus', 'extra', NULL, 'string'),
                ('others', 'o_orderdate', 'extra', NULL, 'timestamp'),
                ('others', 'o_orderpriority', 'extra', NULL, 'string')
            ) AS fields(delivery, field, status, expected, actual) USING (delivery)""",
        "enforced_schema": """
            SELECT o_orderkey, o_custkey, o_totalprice, NULL::VARCHAR AS o_clerk FROM orders""",
        "schema_comparison": _from("bronze", _schema_comparison()),
        "standardized_feed": _from("bronze", f"SELECT {BRONZE_COLUMNS} FROM bronze"),
        "source_file_rows": _from(
            "bronze", "SELECT taxi_type AS folder, count(*) AS n_rows FROM bronze GROUP BY taxi_type"
        ),
        # The feed's columns and the load time.
        "table_shape": _from(
            "bronze",
            _union(
                [
                    f"SELECT '{feed}' AS taxi_type, count(*) AS total_rows,"
                    f" {len(_FEED_COLUMNS[feed]) + 1} AS total_columns FROM {_FEED_TABLES[feed]}"
                    for feed in FEEDS
                ]
            ),
        ),
        "merged_deliveries": """
            SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice) FROM orders""",
        "dedup_lineage": """
            SELECT l_orderkey, l_linenumber, l_quantity, unnest.t AS processed_timestamp, unnest.f AS source_file
            FROM (
                SELECT l_orderkey, l_linenumber, l_quantity, unnest(
                    CASE WHEN l_orderkey % 2 = 0 THEN [{'t': 86400::BIGINT, 'f': 'a'}]
                    ELSE [{'t': 86400::BIGINT, 'f': 'b'}] END) AS unnest
                FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity FROM lineitem))""",
        "nan_quantiles": """
            WITH p AS (
                SELECT CASE WHEN l_partkey % 7 = 0 THEN 'nan'::DOUBLE ELSE l_extendedprice END AS price
                FROM lineitem WHERE l_partkey % 11 <> 0
            ), r AS (
                SELECT price, row_number() OVER (ORDER BY price) AS place, count(*) OVER () AS n FROM p
            )
            SELECT q::DOUBLE AS p, isnan(price) AS is_nan, CASE WHEN NOT isnan(price) THEN price END AS value
            FROM r, (SELECT unnest([0.1::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 0.95::DOUBLE]) AS q)
            WHERE place = ceil(q * n)::BIGINT""",
        "zone_schema": """
            SELECT * FROM (VALUES ('LocationID', 'ok', 'int', 'int'), ('Borough', 'ok', 'string', 'string'),
                ('Zone', 'ok', 'string', 'string'), ('service_zone', 'ok', 'string', 'string'))
            AS report(field, status, expected, actual)""",
        "zone_quality": _zone_quality(),
        "describe_numeric": _from(
            "bronze",
            _union(
                [
                    f"SELECT taxi_type, '{c}' AS column_name, count({c}) AS n,"
                    f" round(avg({c}) + 1e-9, 4) AS mean, round(stddev_samp({c}) + 1e-9, 4) AS stddev,"
                    f" round(min({c})::DOUBLE + 1e-9, 4) AS min, round(max({c})::DOUBLE + 1e-9, 4) AS max"
                    f" FROM bronze GROUP BY taxi_type"
                    for c in _DESCRIBED
                ]
            ),
        ),
        "date_range": _from(
            "bronze",
            "SELECT taxi_type, min(pickup_datetime) AS min_date, max(pickup_datetime) AS max_date,"
            " count(*) AS total_records FROM bronze GROUP BY taxi_type",
        ),
        "null_profile": _from("bronze", _null_profile(("processed_timestamp",))),
        "null_summary": _from("bronze", f"SELECT * FROM ({_null_profile(())}) WHERE null_count > 0"),
        "duplicate_profile": _from(
            "deduped",
            "SELECT taxi_type, total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_count,"
            " round((total_rows - distinct_rows) / total_rows * 100 + 1e-9, 4) AS duplicate_percentage FROM"
            " (SELECT taxi_type, count(*) AS total_rows FROM bronze GROUP BY taxi_type)"
            " JOIN (SELECT taxi_type, count(*) AS distinct_rows FROM deduped GROUP BY taxi_type)"
            " USING (taxi_type)",
        ),
        "quality_report": _from("bronze", _quality_report()),
        "invalid_value_checks": _from(
            "bronze",
            _union(
                [
                    f"SELECT taxi_type, '{name}' AS \"check\","
                    f" sum(CASE WHEN {condition} THEN 1 ELSE 0 END)::BIGINT AS n_invalid"
                    f" FROM bronze GROUP BY taxi_type"
                    for name, condition in _CHECKS.items()
                ]
            ),
        ),
        "dedup_rows": _from("deduped", f"SELECT {BRONZE_COLUMNS} FROM deduped"),
        "clean_rows": _from("bronze", f"SELECT {BRONZE_COLUMNS} FROM bronze WHERE {KEEP}"),
        "clean_audit": _from(
            "bronze", _kept_and_removed("bronze", f"(SELECT * FROM bronze WHERE {KEEP})")
        ),
        "clean_rejects": _from(
            "bronze",
            f"SELECT {BRONZE_COLUMNS}, {_FAILED} AS failed_rules FROM bronze"
            f" WHERE NOT coalesce({KEEP}, false)",
        ),
        "rule_failures": _from(
            "bronze",
            _union(
                [
                    f"SELECT taxi_type, '{name}' AS rule,"
                    f" sum(CASE WHEN {rule} THEN 0 ELSE 1 END)::BIGINT AS n_failed"
                    f" FROM bronze GROUP BY taxi_type"
                    for name, rule in RULES.items()
                ]
            ),
        ),
        "derived_features": _from(
            "bronze", f"SELECT {SILVER_COLUMNS} FROM ({_FEATURES.format(source='bronze')})"
        ),
        "iqr_bounds": _from(
            "kept4",
            _union(
                [
                    f"SELECT taxi_type, {step}::INT AS step, '{column}' AS column_name,"
                    f" round(q1 + 1e-9, 6) AS q1, round(q3 + 1e-9, 6) AS q3,"
                    f" round(lower_bound + 1e-9, 6) AS lower_bound, round(upper_bound + 1e-9, 6) AS upper_bound"
                    f" FROM bounds{step}"
                    for step, column in enumerate(OUTLIER_COLUMNS, 1)
                ]
            ),
        ),
        "iqr_filter": _from("silver", f"SELECT {SILVER_COLUMNS} FROM silver"),
        "outlier_audit": _from("silver", _kept_and_removed("prepared", "silver")),
        "zscore_filter": _from("prepared", f", {_ZSCORE_STEPS} SELECT {SILVER_COLUMNS} FROM near4"),
        "layer_counts": _from(
            "silver",
            f"{_LAYERS} UNION ALL SELECT 'gold', 'combined', count(*) FROM silver",
        ),
        "layer_reduction": _from(
            "silver",
            "SELECT b.table_name, b.n_rows AS rows_before, s.n_rows AS rows_after,"
            " round((b.n_rows - s.n_rows) / b.n_rows * 100 + 1e-9, 4) AS pct_removed"
            f" FROM ({_LAYERS}) b JOIN ({_LAYERS}) s ON b.table_name = s.table_name"
            " WHERE b.layer = 'bronze' AND s.layer = 'silver'",
        ),
        "combined_feeds": _from("silver", f"SELECT {SILVER_COLUMNS} FROM silver"),
        "feed_distribution": _from(
            "silver", 'SELECT taxi_type, count(*) AS "count" FROM silver GROUP BY taxi_type'
        ),
        "zone_join": _from(
            "trips_in_zones",
            "SELECT PULocationID, pickup_borough, pickup_zone, pickup_datetime, total_amount"
            " FROM trips_in_zones",
        ),
        "zone_order": _from(
            "zone_totals",
            "SELECT PULocationID, total_trips,"
            " row_number() OVER (ORDER BY total_trips DESC, PULocationID) AS position FROM zone_totals",
        ),
        "time_order": _from(
            "time_totals",
            "SELECT pickup_year, pickup_month, pickup_hour, is_weekend, row_number() OVER"
            " (ORDER BY pickup_year, pickup_month, pickup_hour, is_weekend) AS position FROM time_totals",
        ),
        "feed_order": _from(
            "silver",
            "SELECT taxi_type, row_number() OVER (ORDER BY taxi_type) AS position"
            " FROM silver GROUP BY taxi_type",
        ),
        "zone_aggregate": _from("zone_totals", _ZONE_AGGREGATE),
        "stored_zone_analytics": _from("zone_totals", _ZONE_AGGREGATE),
        "top_zones": _from(
            "zone_totals",
            "SELECT pickup_borough, pickup_zone, total_trips,"
            f" {_means('avg_trip_distance', 'avg_fare_amount')}, {_REVENUE}"
            " FROM (SELECT * FROM zone_totals ORDER BY total_trips DESC, PULocationID LIMIT 10)",
        ),
        "borough_rollup": _from(
            "zone_totals",
            "SELECT pickup_borough, sum(total_trips)::BIGINT AS total_trips,"
            f" {_mean('sum(total_revenue)', 'total_revenue', 2)},"
            f" {_mean('avg(avg_fare_amount)', 'avg_fare_amount')},"
            f" {_weighted('avg_fare_amount', 'avg_fare_amount')}"
            " FROM zone_totals GROUP BY pickup_borough",
        ),
        "time_aggregate": _from("time_totals", _TIME_AGGREGATE),
        "stored_time_analytics": _from("time_totals", _TIME_AGGREGATE),
        "hourly_pattern": _from(
            "time_totals",
            "SELECT pickup_hour, sum(total_trips)::BIGINT AS total_trips,"
            f" {_mean('avg(avg_trip_distance)', 'avg_distance')},"
            f" {_mean('avg(avg_fare_amount)', 'avg_fare')},"
            f" {_weighted('avg_trip_distance', 'avg_distance')},"
            f" {_weighted('avg_fare_amount', 'avg_fare')}"
            " FROM time_totals GROUP BY pickup_hour",
        ),
        "weekend_pattern": _from(
            "time_totals",
            "SELECT is_weekend, sum(total_trips)::BIGINT AS total_trips,"
            f" {_mean('avg(avg_trip_distance)', 'avg_distance')},"
            f" {_mean('avg(avg_trip_duration)', 'avg_duration')},"
            f" {_mean('avg(avg_fare_amount)', 'avg_fare')},"
            f" {_weighted('avg_trip_distance', 'avg_distance')},"
            f" {_weighted('avg_trip_duration', 'avg_duration')},"
            f" {_weighted('avg_fare_amount', 'avg_fare')}"
            " FROM time_totals GROUP BY is_weekend",
        ),
        "monthly_trend": _from(
            "silver",
            "SELECT pickup_year, pickup_month, count(*) AS total_trips,"
            " round(sum(total_amount) + 1e-6, 2) AS total_revenue FROM silver GROUP BY ALL",
        ),
        "payment_analysis": _from(
            "silver",
            "SELECT payment_type, count(*) AS trip_count, round(avg(tip_amount) + 1e-9, 4) AS avg_tip,"
            " round(avg(tip_rate) + 1e-9, 4) AS avg_tip_rate FROM silver GROUP BY payment_type",
        ),
        "fleet_kpis": _from(
            "silver",
            "SELECT round(avg(trip_distance) + 1e-9, 4) AS avg_trip_distance,"
            " round(avg(trip_duration_minutes) + 1e-9, 4) AS avg_trip_duration,"
            " round(avg(average_speed_mph) + 1e-9, 4) AS avg_speed,"
            " round(avg(passenger_count) + 1e-9, 4) AS avg_passengers,"
            " round(avg(fare_amount) + 1e-9, 4) AS avg_fare, round(avg(tip_rate) + 1e-9, 4) AS avg_tip_rate,"
            " round(sum(total_amount) / nullif(sum(trip_duration_minutes), 0) + 1e-9, 4) AS revenue_per_minute"
            " FROM silver",
        ),
        "summary_statistics": _from(
            "silver",
            _union(
                [
                    f"SELECT taxi_type, '{c}' AS column_name, round(avg({c}) + 1e-9, 4) AS mean,"
                    f" round(stddev_samp({c}) + 1e-9, 4) AS stddev, round(min({c})::DOUBLE + 1e-9, 4) AS min,"
                    f" round(max({c})::DOUBLE + 1e-9, 4) AS max,"
                    f" round(quantile_disc({c}, 0.5)::DOUBLE + 1e-9, 4) AS median"
                    f" FROM (SELECT * FROM silver UNION ALL SELECT * REPLACE ('combined' AS taxi_type) FROM silver)"
                    f" GROUP BY taxi_type"
                    for c in _SUMMARISED
                ]
            ),
        ),
        "summary_totals": _from("silver", _summary_totals()),
        "busiest_hour": _from("silver", _top_1("pickup_hour")),
        "busiest_day": _from("silver", _top_1("pickup_day_of_week")),
        "od_pairs": _from(
            "silver",
            "SELECT PULocationID, DOLocationID, count(*) AS total_trips FROM silver GROUP BY ALL"
            " ORDER BY total_trips DESC, PULocationID, DOLocationID LIMIT 10",
        ),
        "revenue_by_feed": _from(
            "silver",
            "SELECT taxi_type, round(sum(total_amount) + 1e-6, 2) AS total_revenue FROM silver GROUP BY taxi_type",
        ),
        "trips_per_hour": _from(
            "silver",
            "SELECT taxi_type, count(*) AS total_trips,"
            " count(DISTINCT date_trunc('hour', pickup_datetime)) AS active_hours,"
            " round(count(*) / count(DISTINCT date_trunc('hour', pickup_datetime)) + 1e-9, 4) AS trips_per_hour"
            " FROM silver GROUP BY taxi_type",
        ),
        "revenue_per_trip": _from(
            "silver",
            "SELECT taxi_type, round(sum(total_amount) / count(*) + 1e-9, 4) AS revenue_per_trip"
            " FROM silver GROUP BY taxi_type",
        ),
        "distance_efficiency": _from(
            "silver",
            "SELECT taxi_type, round(sum(total_amount) / nullif(sum(trip_distance), 0) + 1e-9, 4)"
            " AS revenue_per_mile FROM silver GROUP BY taxi_type",
        ),
        "revenue_share": _from(
            "silver",
            "SELECT PULocationID, round(sum(total_amount) + 1e-6, 2) AS total_revenue,"
            " round(sum(total_amount) / (SELECT sum(total_amount) FROM silver) + 1e-9, 6) AS revenue_share"
            " FROM silver GROUP BY PULocationID",
        ),
        "word_count": """
            SELECT word, count(*) AS "count"
            FROM (SELECT unnest(regexp_split_to_array(text, '\\W+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word""",
        "top_words": """
            SELECT word, count(*) AS "count"
            FROM (SELECT unnest(regexp_split_to_array(text, '\\W+')) AS word FROM documents)
            WHERE word <> '' GROUP BY word ORDER BY "count" DESC, word LIMIT 20""",
        "hit_rate": """
            SELECT count(*) AS n_rows,
                   sum(CASE WHEN hit THEN 1 ELSE 0 END)::BIGINT AS n_hits,
                   round(4.0 * sum(CASE WHEN hit THEN 1 ELSE 0 END) / count(*) + 1e-9, 6) AS estimate
            FROM (SELECT embedding[1]::DOUBLE * embedding[1]::DOUBLE
                         + embedding[2]::DOUBLE * embedding[2]::DOUBLE <= 0.01 AS hit
                  FROM embeddings)""",
    }
