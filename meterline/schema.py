"""Column names and types of the raw trips and of the eight warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw trip record, in file order, with the type each column is expected to have.
RAW_COLUMNS = [
    ("VendorID", T.LongType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.LongType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.LongType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("cbd_congestion_fee", T.DoubleType()),
]
RAW_TRIP = T.StructType([T.StructField(name, kind, True) for name, kind in RAW_COLUMNS])

# The raw record as landed under one layout: the two numbers that some months store as whole
# and others as fractions are fractions in all of them.
LANDED_TRIP = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name in ("passenger_count", "RatecodeID") else kind, True)
        for name, kind in RAW_COLUMNS
    ]
)

# Columns that whole months of raw files may lack, with the value they then take.
OPTIONAL_RAW_COLUMNS = {"airport_fee": 0.0, "cbd_congestion_fee": 0.0}

# The money columns in warehouse order; each is decimal(10,2).
MONEY_COLUMNS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "cbd_congestion_fee",
    "total_amount",
]
MEASURE_COLUMNS = ["passenger_count", "trip_distance", *MONEY_COLUMNS]

MONEY = T.DecimalType(10, 2)
DISTANCE = T.DecimalType(10, 3)

# Model inputs in the order the model takes them, and the value it predicts.
FEATURES = [
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "fare_amount",
    "extra",
    "tip_amount",
    "trip_distance",
]
LABEL = "total_amount"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
# The columns cut from the raw trips for training; the two datetimes are dropped again.
MODEL_COLUMNS = [*FEATURES[:2], PICKUP, DROPOFF, *FEATURES[2:], LABEL]


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


DIM_VENDOR = _table(
    ("vendor_id", T.ShortType(), False),
    ("vendor_name", T.StringType(), False),
)
DIM_RATECODE = _table(
    ("ratecode_id", T.ShortType(), False),
    ("ratecode_label", T.StringType(), False),
)
DIM_PAYMENT_TYPE = _table(
    ("payment_type_id", T.ShortType(), False),
    ("payment_type_label", T.StringType(), True),
)
DIM_STORE_AND_FWD = _table(
    ("store_and_fwd_flag", T.StringType(), False),
    ("label", T.StringType(), False),
)
DIM_ZONE = _table(
    ("location_id", T.IntegerType(), False),
    ("borough", T.StringType(), True),
    ("zone_name", T.StringType(), True),
    ("service_zone", T.StringType(), True),
)
DIM_DATE = _table(
    ("date_key", T.IntegerType(), False),
    ("full_date", T.DateType(), False),
    ("year", T.ShortType(), False),
    ("month", T.ShortType(), False),
    ("day", T.ShortType(), False),
    ("day_of_week", T.ShortType(), False),
    ("is_weekend", T.BooleanType(), False),
)
# full_time is text (HH:mm:ss): Spark's TIME type is still off by default.
DIM_TIME = _table(
    ("time_key", T.IntegerType(), False),
    ("full_time", T.StringType(), False),
    ("hour", T.ShortType(), False),
    ("minute", T.ShortType(), False),
    ("second", T.ShortType(), False),
)
FACT_TRIP = _table(
    ("trip_id", T.LongType(), False),
    ("vendor_id", T.ShortType(), False),
    ("ratecode_id", T.ShortType(), False),
    ("payment_type_id", T.ShortType(), False),
    ("store_and_fwd_flag", T.StringType(), False),
    ("pu_location_id", T.IntegerType(), False),
    ("do_location_id", T.IntegerType(), False),
    ("pu_date_key", T.IntegerType(), False),
    ("do_date_key", T.IntegerType(), False),
    ("pu_time_key", T.IntegerType(), False),
    ("do_time_key", T.IntegerType(), False),
    ("pickup_datetime", T.TimestampNTZType(), False),
    ("dropoff_datetime", T.TimestampNTZType(), False),
    ("passenger_count", T.ShortType(), False),
    ("trip_distance", DISTANCE, False),
    *[(name, MONEY, False) for name in MONEY_COLUMNS],
)
# Everything the loader writes: the identity is assigned at load, not derived from the trip.
FACT_COLUMNS = [name for name in FACT_TRIP.names if name != "trip_id"]

TABLES = {
    "dim_vendor": DIM_VENDOR,
    "dim_ratecode": DIM_RATECODE,
    "dim_payment_type": DIM_PAYMENT_TYPE,
    "dim_store_and_fwd": DIM_STORE_AND_FWD,
    "dim_zone": DIM_ZONE,
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "fact_trip": FACT_TRIP,
}

# Primary keys of all tables and the two further unique columns.
PRIMARY_KEYS = {name: schema.names[0] for name, schema in TABLES.items()}
UNIQUE_COLUMNS = {"dim_date": "full_date", "dim_time": "full_time"}

# Fact column -> (dimension, its key).
FOREIGN_KEYS = {
    "vendor_id": ("dim_vendor", "vendor_id"),
    "ratecode_id": ("dim_ratecode", "ratecode_id"),
    "payment_type_id": ("dim_payment_type", "payment_type_id"),
    "store_and_fwd_flag": ("dim_store_and_fwd", "store_and_fwd_flag"),
    "pu_location_id": ("dim_zone", "location_id"),
    "do_location_id": ("dim_zone", "location_id"),
    "pu_date_key": ("dim_date", "date_key"),
    "do_date_key": ("dim_date", "date_key"),
    "pu_time_key": ("dim_time", "time_key"),
    "do_time_key": ("dim_time", "time_key"),
}
