"""Raw trips to fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterline import schema
from meterline.functions import date_key, flag_letter, narrow, time_key, to_amount
from meterline.operators.columns import complete_raw
from meterline.operators.rules import accept, trip_rules


def conform(df: DataFrame, *keep: str) -> DataFrame:
    """Every raw trip as a fact row without its identity, plus the columns in `keep`.

    Does not filter: values that do not fit become NULL, so put `accept` before it.
    """
    pickup, dropoff = f"CAST({schema.PICKUP} AS TIMESTAMP_NTZ)", f"CAST({schema.DROPOFF} AS TIMESTAMP_NTZ)"
    return df.selectExpr(
        *keep,
        f"{narrow('VendorID', 'smallint')} AS vendor_id",
        f"{narrow('RatecodeID', 'smallint')} AS ratecode_id",
        f"{narrow('payment_type', 'smallint')} AS payment_type_id",
        f"{flag_letter('store_and_fwd_flag')} AS store_and_fwd_flag",
        f"{narrow('PULocationID', 'int')} AS pu_location_id",
        f"{narrow('DOLocationID', 'int')} AS do_location_id",
        f"{date_key(pickup)} AS pu_date_key",
        f"{date_key(dropoff)} AS do_date_key",
        f"{time_key(pickup)} AS pu_time_key",
        f"{time_key(dropoff)} AS do_time_key",
        f"{pickup} AS pickup_datetime",
        f"{dropoff} AS dropoff_datetime",
        f"{narrow('coalesce(passenger_count, 0)', 'smallint')} AS passenger_count",
        f"{to_amount('trip_distance', schema.DISTANCE)} AS trip_distance",
        *[f"{to_amount(name, schema.MONEY)} AS {name}" for name in schema.MONEY_COLUMNS],
    )


def fact_rows(raw: DataFrame, year: int, *keep: str) -> DataFrame:
    """Fact rows of the trips of `year` that pass every rule: one scan, no shuffle."""
    return conform(accept(complete_raw(raw), trip_rules(year)), *keep)
