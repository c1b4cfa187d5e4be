"""The seven dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.functions import (
    date_key,
    day_of_week,
    hour_of,
    is_weekend,
    minute_of,
    second_of,
    seconds_to_key,
    seconds_to_text,
)

# The code lists.
VENDORS = [
    (0, "Unknown"),
    (1, "Creative Mobile Technologies, LLC"),
    (2, "Curb Mobility, LLC"),
    (6, "Myle Technologies Inc"),
    (7, "Helix"),
]
RATECODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]
PAYMENT_TYPES = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
STORE_AND_FWD_FLAGS = [
    ("Y", "Store and forward trip"),
    ("N", "Not a store and forward trip"),
]

SECONDS_PER_DAY = 24 * 60 * 60


def _inline(spark: SparkSession, rows: list[tuple], table: T.StructType) -> DataFrame:
    # An inline table: unlike a parallelised list, Spark knows its size and plans joins by it.
    values = ", ".join(f"({key!r}, {label!r})" for key, label in rows)
    columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in table)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS seed({', '.join(table.names)})")


def vendors(spark: SparkSession) -> DataFrame:
    return _inline(spark, VENDORS, schema.DIM_VENDOR)


def ratecodes(spark: SparkSession) -> DataFrame:
    return _inline(spark, RATECODES, schema.DIM_RATECODE)


def payment_types(spark: SparkSession) -> DataFrame:
    return _inline(spark, PAYMENT_TYPES, schema.DIM_PAYMENT_TYPE)


def store_and_fwd_flags(spark: SparkSession) -> DataFrame:
    return _inline(spark, STORE_AND_FWD_FLAGS, schema.DIM_STORE_AND_FWD)


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from `first` to `last`, both included."""
    days = spark.range((last - first).days + 1)
    return _calendar_columns(days.selectExpr(f"date_add(DATE'{first}', CAST(id AS INT)) AS full_date"))


def year_calendar(spark: SparkSession, year: int, days_after: int = 1) -> DataFrame:
    """The days of `year`, and by default the next 1 January: the last trips end there."""
    return calendar(spark, dt.date(year, 1, 1), dt.date(year, 12, 31) + dt.timedelta(days=days_after))


def calendar_spanning(days: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest date in `column`."""
    span = days.selectExpr(f"min({column}) AS first", f"max({column}) AS last")
    return _calendar_columns(span.selectExpr("explode(sequence(first, last)) AS full_date"))


def _calendar_columns(days: DataFrame) -> DataFrame:
    return days.selectExpr(
        f"{date_key('full_date')} AS date_key",
        "full_date",
        "CAST(year(full_date) AS SMALLINT) AS year",
        "CAST(month(full_date) AS SMALLINT) AS month",
        "CAST(day(full_date) AS SMALLINT) AS day",
        f"CAST({day_of_week('full_date')} AS SMALLINT) AS day_of_week",
        f"{is_weekend('full_date')} AS is_weekend",
    )


def day_seconds(spark: SparkSession) -> DataFrame:
    """One row per second of the day."""
    return spark.range(SECONDS_PER_DAY).selectExpr(
        f"{seconds_to_key('id')} AS time_key",
        f"{seconds_to_text('id')} AS full_time",
        f"CAST({hour_of('id')} AS SMALLINT) AS hour",
        f"CAST({minute_of('id')} AS SMALLINT) AS minute",
        f"CAST({second_of('id')} AS SMALLINT) AS second",
    )


def seed_dimensions(spark: SparkSession, zones: DataFrame, year: int) -> dict[str, DataFrame]:
    """All seven by table name; the zones come from their lookup file."""
    return {
        "dim_vendor": vendors(spark),
        "dim_ratecode": ratecodes(spark),
        "dim_payment_type": payment_types(spark),
        "dim_store_and_fwd": store_and_fwd_flags(spark),
        "dim_zone": zones,
        "dim_date": year_calendar(spark, year),
        "dim_time": day_seconds(spark),
    }


def usage(dimension: DataFrame, key: str, rows: DataFrame, column: str, into: str = "trips") -> DataFrame:
    """Every dimension row with the number of `rows` whose `column` holds its key.

    The rows are counted per key before the join, so only one row per key moves.
    """
    counted = rows.groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias(into))
    joined = dimension.join(counted, key, "left")
    return joined.withColumn(into, F.expr(f"coalesce({into}, 0L)"))
