import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from fareloom.session import get_spark  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

TRIP_DDL = (
    "pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count bigint, trip_distance double, "
    "fare_amount double, total_amount double, tip_amount double, PULocationID int, DOLocationID int"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trip(spark):
    """A table of trips that pass every rule, but for the values given per row."""

    def build(*changes):
        good = {
            "pickup_datetime": datetime(2025, 1, 1, 10, 0, 0),
            "dropoff_datetime": datetime(2025, 1, 1, 10, 30, 0),
            "passenger_count": 1,
            "trip_distance": 5.0,
            "fare_amount": 20.0,
            "total_amount": 22.0,
            "tip_amount": 4.0,
            "PULocationID": 1,
            "DOLocationID": 2,
        }
        rows = [tuple((good | change).values()) for change in changes]
        return spark.createDataFrame(rows, TRIP_DDL)

    return build


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text, before it is run."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
