"""Raw trips and zones derived from the test tables, one trip per event.

Plain arithmetic on the event, so that SQL elsewhere can state the same trips. Every rule
of the warehouse meets rows that break it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = 2024

_E = "event_id"


def _every(step: int, rest: int = 0) -> Column:
    return F.col(_E) % step == rest


def trips_from_events(events: DataFrame) -> DataFrame:
    """The raw trips, with `event_id` as a unique key beside the raw columns."""
    moment = F.col("moment")
    lasting = F.make_dt_interval(secs=(F.col(_E) % 3600 - 60).cast("decimal(18,6)"))
    days = {n: F.make_dt_interval(days=F.lit(n)) for n in (365, 366)}
    pickup_zone = F.when(~_every(107), F.col("user_id") + 1).cast("int")
    value = F.col("value")
    whole_second = F.make_timestamp_ntz(
        F.year("ts"), F.month("ts"), F.day("ts"), F.hour("ts"), F.minute("ts"), F.second("ts")
    )
    return events.select(_E, "user_id", "value", whole_second.alias("moment")).select(
        _E,
        F.when(_every(97), None)
        .when(_every(211), 5)
        .when(_every(4), 1)
        .when(_every(4, 1), 2)
        .when(_every(4, 2), 6)
        .otherwise(7)
        .cast("bigint")
        .alias("VendorID"),
        F.when(_every(101, 3), None)
        .when(_every(89), moment - days[365])
        .otherwise(moment)
        .alias("tpep_pickup_datetime"),
        F.when(_every(103, 5), None)
        .when(_every(1009, 7), moment + days[366])
        .otherwise(moment + lasting)
        .alias("tpep_dropoff_datetime"),
        F.when(_every(41), None).when(_every(311), -1).otherwise(F.col(_E) % 6).cast("bigint").alias("passenger_count"),
        F.when(_every(83), -value / 10).otherwise(value / 10).alias("trip_distance"),
        F.when(_every(61), None).when(_every(7), 99).otherwise(F.col(_E) % 7).cast("bigint").alias("RatecodeID"),
        F.when(_every(13), None)
        .when(_every(401), "")
        .when(_every(17, 1), "Y")
        .otherwise("N")
        .alias("store_and_fwd_flag"),
        pickup_zone.alias("PULocationID"),
        F.when(~_every(109), F.col(_E) * 7 % 265 + 1).cast("int").alias("DOLocationID"),
        F.when(~_every(113), F.col(_E) % 7).cast("bigint").alias("payment_type"),
        F.when(_every(53), -value).otherwise(value).alias("fare_amount"),
        F.when(_every(67), None).when(_every(4, 3), 2.5).otherwise(1.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        ((F.col(_E) % 500) / 100).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (value + 5).alias("total_amount"),
        F.when(_every(59), -2.5).otherwise(2.5).alias("congestion_surcharge"),
        F.when(pickup_zone.isin(132, 138), 1.75).otherwise(0.0).alias("Airport_fee"),
        F.lit(0.75).alias("cbd_congestion_fee"),
    )


def zones_from_places(spark: SparkSession, region: DataFrame, nation: DataFrame) -> DataFrame:
    """265 zones named after the regions and nations, as the lookup file has them."""
    number = F.col("LocationID")
    zones = spark.range(1, 266).select(F.col("id").cast("int").alias("LocationID"))
    return (
        zones.join(region, F.col("r_regionkey") == number % 5, "left")
        .join(nation, F.col("n_nationkey") == number % 25, "left")
        .select(
            "LocationID",
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.when(number % 50 == 0, "Airports")
            .when(number.isin(264, 265), "N/A")
            .otherwise("Boro Zone")
            .alias("service_zone"),
        )
    )
