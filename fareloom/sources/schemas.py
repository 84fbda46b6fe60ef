"""Declared input schemas and the per-feed column names."""

from pyspark.sql.types import StructType


def declared(columns: dict[str, str]) -> StructType:
    """Nullable fields from names and types; needs no running session."""
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


# Column names, types and order of the three inputs. All fields are nullable.
YELLOW_SCHEMA = declared(
    {
        "VendorID": "integer",
        "tpep_pickup_datetime": "timestamp",
        "tpep_dropoff_datetime": "timestamp",
        "passenger_count": "long",
        "trip_distance": "double",
        "RatecodeID": "long",
        "store_and_fwd_flag": "string",
        "PULocationID": "integer",
        "DOLocationID": "integer",
        "payment_type": "long",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "congestion_surcharge": "double",
        "Airport_fee": "double",
        "cbd_congestion_fee": "double",
    }
)

GREEN_SCHEMA = declared(
    {
        "VendorID": "integer",
        "lpep_pickup_datetime": "timestamp",
        "lpep_dropoff_datetime": "timestamp",
        "store_and_fwd_flag": "string",
        "RatecodeID": "long",
        "PULocationID": "integer",
        "DOLocationID": "integer",
        "passenger_count": "long",
        "trip_distance": "double",
        "fare_amount": "double",
        "extra": "double",
        "mta_tax": "double",
        "tip_amount": "double",
        "tolls_amount": "double",
        "ehail_fee": "double",
        "improvement_surcharge": "double",
        "total_amount": "double",
        "payment_type": "long",
        "trip_type": "long",
        "congestion_surcharge": "double",
    }
)

ZONE_SCHEMA = declared(
    {
        "LocationID": "integer",
        "Borough": "string",
        "Zone": "string",
        "service_zone": "string",
    }
)

# What each feed calls its two time columns.
FEED_RENAMES = {
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
    },
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
    },
}

# Lineage columns added on ingestion.
PROCESSED_AT = "processed_timestamp"
SOURCE_FILE = "source_file"
FEED = "taxi_type"
LOAD_COLUMNS = (PROCESSED_AT, SOURCE_FILE)

FEED_SCHEMAS = {"yellow": YELLOW_SCHEMA, "green": GREEN_SCHEMA}
