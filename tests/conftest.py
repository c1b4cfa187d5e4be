import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterline import schema  # noqa: E402
from meterline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


BASE = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 3, 5, 1, 2, 3),
    "tpep_dropoff_datetime": dt.datetime(2024, 3, 5, 1, 12, 3),
    "passenger_count": 1,
    "trip_distance": 2.5,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 17.5,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
}


@pytest.fixture
def raw(spark):
    """Raw trips, one per argument: the base row with that argument's changes."""

    def make(*changes):
        rows = [{**BASE, **change} for change in changes]
        values = [tuple(row[name] for name in schema.RAW_TRIP.names) for row in rows]
        return spark.createDataFrame(values, schema.RAW_TRIP)

    return make
