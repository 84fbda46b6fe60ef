"""Trips shaped like the declared feeds, derived from the order tables.

Every line item becomes a trip; some become two identical ones, and some carry the
flaws the operators look for: NULLs, negative and oversized values, times out of order, a place no zone lists.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.sources.schemas import FEED_RENAMES, FEED_SCHEMAS

# SQL over the joined order tables; the oracle queries use the same text. The two
# intervals and the copies are spelled separately because engines differ there.
TRIP_EXPRESSIONS = {
    "VendorID": "cast(l_suppkey % 2 + 1 as int)",
    "pickup_datetime": "o_orderdate + ((l_orderkey * 7 + l_linenumber) % 24) * INTERVAL '1' HOUR",
    "ride": "case when l_partkey % 41 = 0 then 300 else l_partkey % 60 - 3 end",
    "passenger_count": "cast(case when l_orderkey % 20 = 0 then null else l_linenumber - 1 end as bigint)",
    "trip_distance": "case when l_partkey % 97 = 0 then -l_quantity"
    " when l_partkey % 53 = 0 then l_quantity * 30 else l_quantity / 4 end",
    "RatecodeID": "cast(l_orderkey % 6 + 1 as bigint)",
    "store_and_fwd_flag": "case when l_returnflag = 'R' then 'Y' else 'N' end",
    "PULocationID": "case when l_partkey % 61 = 0 then 264 else c_nationkey end",
    "DOLocationID": "s_nationkey",
    "payment_type": "cast(substr(o_orderpriority, 1, 1) as bigint)",
    "fare_amount": "case when l_suppkey % 25 = 7 then l_extendedprice / 100 else l_extendedprice / 1000 end",
    "extra": "cast(0.5 as double)",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": "case when l_orderkey % 33 = 0 then null else l_extendedprice / 1000 * l_tax end",
    "tolls_amount": "l_discount * 10",
    "improvement_surcharge": "cast(1.0 as double)",
    "congestion_surcharge": "cast(case when l_linenumber = 1 then null else 2.5 end as double)",
    "feed": "case when l_linestatus = 'O' then 'yellow' else 'green' end",
    "copies": "case when l_partkey % 211 = 0 then 2 else 1 end",
}
TOTAL_AMOUNT = "fare_amount + 2"
DROPOFF = "pickup_datetime + ride * INTERVAL '1' MINUTE"

# Columns only one feed has.
FEED_ONLY = {
    "yellow": {"Airport_fee": "cast(0.0 as double)", "cbd_congestion_fee": "cast(0.75 as double)"},
    "green": {"ehail_fee": "cast(null as double)", "trip_type": "cast(1 as bigint)"},
}
FEEDS = list(FEED_ONLY)


def delivered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips of all feeds, with the feed each belongs to in ``feed``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Orders meet their customers first, so that the far more numerous line items are not
    # shuffled on the customer. Small sides are broadcast if the session's threshold allows.
    placed = table("orders").join(table("customer"), F.expr("o_custkey = c_custkey"))
    joined = (
        table("lineitem")
        .join(placed, F.expr("l_orderkey = o_orderkey"))
        .join(table("supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    return (
        joined.selectExpr(*(f"{sql} as {name}" for name, sql in TRIP_EXPRESSIONS.items()))
        .selectExpr("*", f"{TOTAL_AMOUNT} as total_amount", f"{DROPOFF} as dropoff_datetime")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .drop("ride", "copies", "copy")
    )


def as_feed(trips: DataFrame, feed: str) -> DataFrame:
    """One feed's trips under the names, columns and order that feed is delivered with."""
    delivered_name = {common: own for own, common in FEED_RENAMES[feed].items()}
    extra = {name: F.expr(sql) for name, sql in FEED_ONLY[feed].items()}
    return (
        trips.filter(F.col("feed") == feed)
        .withColumnsRenamed(delivered_name)
        .withColumns(extra)
        .select(*FEED_SCHEMAS[feed].fieldNames())
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones and regions as boroughs; place 264 is not listed."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Z").alias("service_zone"),
    )