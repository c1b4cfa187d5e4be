"""Questions the star schema is there to answer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def star_view(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows with the attributes of all dimensions; zones, dates and times once per role.

    Left joins: a trip whose key has no dimension row stays, with NULL attributes. Spark sends
    a dimension to all tasks if it sees that it is small enough.
    """
    view = fact
    for table, key in (
        ("dim_vendor", "vendor_id"),
        ("dim_ratecode", "ratecode_id"),
        ("dim_payment_type", "payment_type_id"),
    ):
        view = view.join(dimensions[table], key, "left")
    flags = dimensions["dim_store_and_fwd"].withColumnRenamed("label", "store_and_fwd_label")
    view = view.join(flags, "store_and_fwd_flag", "left")
    for role in ("pu", "do"):
        for table, key in (("dim_zone", "location_id"), ("dim_date", "date_key"), ("dim_time", "time_key")):
            dimension = dimensions[table]
            played = dimension.toDF(*[f"{role}_{name}" for name in dimension.columns])
            view = view.join(played, f"{role}_{key}", "left")
    return view


def weekday_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Trips and revenue by pickup weekday.

    Rows are added up per date before the dates are looked up, so the join sees one row
    per day instead of one per trip.
    """
    daily = fact.groupBy(F.col("pu_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue")
    )
    return (
        daily.join(dim_date, "date_key", "left")
        .groupBy("day_of_week", "is_weekend")
        .agg(F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue"))
    )
