"""Every query against its SQL, on the whole of the smallest tables."""

import pytest

from __spark_entry__ import entry
from meterline.plans.catalog import QUERIES, fitting_memory, trained
from meterline.plans.catalog_sql import SQL
from tools.compare import oracle, same

SF_DIR = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    mine = QUERIES[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(SQL[name]).df()
    assert same(mine, theirs) == ""


def test_entry(spark):
    assert entry(spark).count() == 814


# Rows failing each rule at scale 0.001, worked out beforehand.
KNOWN = {
    "VendorID_present": 11,
    "pickup_present": 10,
    "dropoff_present": 10,
    "RatecodeID_present": 17,
    "payment_type_present": 9,
    "PULocationID_present": 10,
    "DOLocationID_present": 10,
    "passenger_count_not_negative": 3,
    "trip_distance_not_negative": 13,
    "fare_amount_not_negative": 19,
    "congestion_surcharge_not_negative": 17,
}


def test_known_counts(spark):
    counts = {row["rule"]: row["failed"] for row in QUERIES["reject_counts"](spark, SF_DIR).collect()}
    assert {name: counts[name] for name in KNOWN} == KNOWN


def test_fitted_model(spark):
    """The model's own settings, fitted once for all queries."""
    frame, result, path = trained(spark, SF_DIR)
    assert trained(spark, SF_DIR)[1] is result
    regressor = result.model.stages[-1]
    assert (regressor.getNumTrees, regressor.getMaxDepth(), regressor.getSeed()) == (100, 15, 42)
    spread = frame.agg({"total_amount": "stddev_pop"}).first()[0]
    assert result.rmse < spread / 2 and result.saved == (result.rmse < 10)
    with pytest.raises(MemoryError):
        fitting_memory(spark, 10**9)
