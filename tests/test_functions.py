import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterline import schema
from meterline.functions import hhmmss_interval, hhmmss_seconds, within_year
from meterline.operators import dimensions
from meterline.operators.metrics import passes_gate, rmse


@pytest.mark.parametrize(
    "packed, seconds", [(123456, 45296), (5, 5), (0, 0), (235959, 86399), (999999, 362439), (1234567, 45296), (-50, 50), (-5, 5), (-12345, -2175)]
)
def test_hhmmss(spark, packed, seconds):
    row = spark.range(1).selectExpr(f"{hhmmss_seconds(packed)} AS s", f"{hhmmss_interval(packed)} AS i").first()
    assert row["s"] == seconds
    assert row["i"] == dt.timedelta(seconds=seconds)


def test_year_bounds_do_not_move_with_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moments = spark.sql(
            "SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:00:00'), (timestamp_ntz'2023-12-31 23:59:59'),"
            "(timestamp_ntz'2024-12-31 23:59:59'), (timestamp_ntz'2024-03-10 02:30:00') AS t(m)"
        )
        inside = [row[0] for row in moments.selectExpr(within_year("m", 2024)).collect()]
        assert inside == [True, False, True, True]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar(spark):
    days = dimensions.calendar(spark, dt.date(2025, 1, 1), dt.date(2025, 12, 31))
    assert [(f.name, f.dataType) for f in days.schema] == [(f.name, f.dataType) for f in schema.DIM_DATE]
    assert days.count() == 365
    assert days.filter("is_weekend").count() == 104
    sunday = days.filter("date_key = 20250105").first()
    assert (sunday["day_of_week"], sunday["is_weekend"], sunday["full_date"]) == (7, True, dt.date(2025, 1, 5))
    assert dimensions.year_calendar(spark, 2024).count() == 367


def test_seconds(spark):
    seconds = dimensions.day_seconds(spark)
    assert [(f.name, f.dataType) for f in seconds.schema] == [(f.name, f.dataType) for f in schema.DIM_TIME]
    summary = seconds.agg(F.countDistinct("time_key"), F.countDistinct("full_time"), F.max("time_key")).first()
    assert tuple(summary) == (86400, 86400, 235959)
    assert seconds.filter("time_key = 10203").first()["full_time"] == "01:02:03"


def test_code_lists(spark):
    keys = {
        "vendor_id": [0, 1, 2, 6, 7],
        "ratecode_id": [1, 2, 3, 4, 5, 6, 99],
        "payment_type_id": [0, 1, 2, 3, 4, 5, 6],
        "store_and_fwd_flag": ["N", "Y"],
    }
    tables = [f(spark) for f in (dimensions.vendors, dimensions.ratecodes, dimensions.payment_types)]
    tables.append(dimensions.store_and_fwd_flags(spark))
    for (key, values), table in zip(keys.items(), tables, strict=True):
        assert sorted(row[key] for row in table.collect()) == values


def test_rmse_and_gate(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], "y double, p double")
    assert rows.agg(rmse(F.col("y"), F.col("p"))).first()[0] == pytest.approx(12.5**0.5)
    errors = spark.createDataFrame([(9.99,), (10.0,), (None,), (float("nan"),)], "e double")
    assert [row[0] for row in errors.select(passes_gate(F.col("e"))).collect()] == [True, False, False, False]
