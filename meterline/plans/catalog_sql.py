"""The catalog's queries in DuckDB SQL, stated from the data model and not from the Spark code."""

from __future__ import annotations

# One trip per event; see sources.derived.
TRIPS = """
base AS (
  SELECT event_id AS e, user_id, value, date_trunc('second', ts) AS t FROM events
),
trips AS (
  SELECT
    e AS event_id,
    CASE WHEN e % 97 = 0 THEN NULL WHEN e % 211 = 0 THEN 5 WHEN e % 4 = 0 THEN 1
         WHEN e % 4 = 1 THEN 2 WHEN e % 4 = 2 THEN 6 ELSE 7 END AS VendorID,
    CASE WHEN e % 101 = 3 THEN NULL WHEN e % 89 = 0 THEN t - INTERVAL 365 DAY ELSE t END AS pickup,
    CASE WHEN e % 103 = 5 THEN NULL WHEN e % 1009 = 7 THEN t + INTERVAL 366 DAY
         ELSE t + to_seconds(e % 3600 - 60) END AS dropoff,
    CASE WHEN e % 41 = 0 THEN NULL WHEN e % 311 = 0 THEN -1 ELSE e % 6 END AS passenger_count,
    CASE WHEN e % 83 = 0 THEN -value / 10 ELSE value / 10 END AS trip_distance,
    CASE WHEN e % 61 = 0 THEN NULL WHEN e % 7 = 0 THEN 99 ELSE e % 7 END AS RatecodeID,
    CASE WHEN e % 13 = 0 THEN NULL WHEN e % 401 = 0 THEN '' WHEN e % 17 = 1 THEN 'Y' ELSE 'N' END
      AS store_and_fwd_flag,
    CASE WHEN e % 107 = 0 THEN NULL ELSE user_id + 1 END AS PULocationID,
    CASE WHEN e % 109 = 0 THEN NULL ELSE (e * 7) % 265 + 1 END AS DOLocationID,
    CASE WHEN e % 113 = 0 THEN NULL ELSE e % 7 END AS payment_type,
    CASE WHEN e % 53 = 0 THEN -value ELSE value END AS fare_amount,
    CASE WHEN e % 67 = 0 THEN NULL WHEN e % 4 = 3 THEN 2.5 ELSE 1.0 END::DOUBLE AS extra,
    0.5::DOUBLE AS mta_tax,
    (e % 500)::DOUBLE / 100 AS tip_amount,
    0.0::DOUBLE AS tolls_amount,
    1.0::DOUBLE AS improvement_surcharge,
    value + 5 AS total_amount,
    CASE WHEN e % 59 = 0 THEN -2.5 ELSE 2.5 END::DOUBLE AS congestion_surcharge,
    CASE WHEN e % 107 <> 0 AND user_id + 1 IN (132, 138) THEN 1.75 ELSE 0.0 END::DOUBLE AS airport_fee,
    0.75::DOUBLE AS cbd_congestion_fee
  FROM base
)"""

MONEY = [
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
MEASURES = ["passenger_count", "trip_distance", *MONEY]

# (rule, condition to keep the row), in order.
RULES = [
    ("pickup_present", "pickup IS NOT NULL"),
    ("dropoff_present", "dropoff IS NOT NULL"),
    ("dropoff_not_before_pickup", "dropoff >= pickup"),
    *[
        (f"{c}_present", f"{c} IS NOT NULL")
        for c in ("VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID")
    ],
    ("pickup_in_year", "CAST(strftime(pickup, '%Y%m%d') AS INTEGER) BETWEEN 20240101 AND 20241231"),
    *[(f"{c}_not_negative", f"coalesce({c}, 0) >= 0") for c in MEASURES],
    *[
        (f"{c}_fits", f"{c} IS NULL OR TRY_CAST({c} AS SMALLINT) IS NOT NULL")
        for c in ("VendorID", "RatecodeID", "payment_type")
    ],
    *[
        (f"{c}_fits", f"{c} IS NULL OR TRY_CAST({c} AS INTEGER) IS NOT NULL")
        for c in ("PULocationID", "DOLocationID")
    ],
    ("passenger_count_fits", "passenger_count IS NULL OR TRY_CAST(passenger_count AS SMALLINT) IS NOT NULL"),
    ("trip_distance_fits", "trip_distance IS NULL OR TRY_CAST(trip_distance AS DECIMAL(10,3)) IS NOT NULL"),
    *[(f"{c}_fits", f"{c} IS NULL OR TRY_CAST({c} AS DECIMAL(10,2)) IS NOT NULL") for c in MONEY],
]


def key(column: str) -> tuple[str, str]:
    return (
        f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)",
        f"CAST(strftime({column}, '%H%M%S') AS INTEGER)",
    )


_PU, _DO = key("pickup"), key("dropoff")

# Every trip as a fact row, judged or not.
CONFORMED = f"""
conformed AS (
  SELECT event_id, VendorID AS vendor_id, RatecodeID AS ratecode_id, payment_type AS payment_type_id,
    substr(coalesce(store_and_fwd_flag, 'N'), 1, 1) AS store_and_fwd_flag,
    PULocationID AS pu_location_id, DOLocationID AS do_location_id,
    {_PU[0]} AS pu_date_key, {_DO[0]} AS do_date_key, {_PU[1]} AS pu_time_key, {_DO[1]} AS do_time_key,
    pickup AS pickup_datetime, dropoff AS dropoff_datetime,
    coalesce(passenger_count, 0) AS passenger_count,
    CAST(coalesce(trip_distance, 0) AS DECIMAL(10,3)) AS trip_distance,
    {", ".join(f"CAST(coalesce({c}, 0) AS DECIMAL(10,2)) AS {c}" for c in MONEY)},
    {" AND ".join(f"coalesce({condition}, false)" for _, condition in RULES)} AS accepted
  FROM trips
)"""
FACT = f"{CONFORMED}, fact AS (SELECT * FROM conformed WHERE accepted)"

# The 265 zones; see sources.derived.
ZONES = """
zones AS (
  SELECT CAST(id AS INTEGER) AS location_id, r_name AS borough, n_name AS zone_name,
    CASE WHEN id % 50 = 0 THEN 'Airports' WHEN id IN (264, 265) THEN 'N/A' ELSE 'Boro Zone' END AS service_zone
  FROM range(1, 266) AS ids(id)
  JOIN region ON r_regionkey = id % 5
  JOIN nation ON n_nationkey = id % 25
)"""

# The code lists.
VENDORS = """
vendors(vendor_id, vendor_name) AS (VALUES
  (0, 'Unknown'), (1, 'Creative Mobile Technologies, LLC'), (2, 'Curb Mobility, LLC'),
  (6, 'Myle Technologies Inc'), (7, 'Helix'))"""
RATECODES = """
ratecodes(ratecode_id, ratecode_label) AS (VALUES
  (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'),
  (5, 'Negotiated fare'), (6, 'Group ride'), (99, 'Null/unknown'))"""
PAYMENT_TYPES = """
payment_types(payment_type_id, payment_type_label) AS (VALUES
  (0, 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
  (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip'))"""
FLAGS = """
flags(store_and_fwd_flag, label) AS (VALUES
  ('Y', 'Store and forward trip'), ('N', 'Not a store and forward trip'))"""


def calendar(name: str, first: str, last: str) -> str:
    """The days from `first` to `last` (SQL dates), both included."""
    return f"""
{name} AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
    year(d) AS "year", month(d) AS "month", day(d) AS "day",
    isodow(d) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)
)"""


YEAR_CALENDAR = calendar("days", "DATE '2024-01-01'", "DATE '2025-01-01'")

_IN_CALENDAR = "{0} >= TIMESTAMP '2024-01-01' AND {0} < TIMESTAMP '2025-01-02'"

SECONDS = """
seconds AS (
  SELECT CAST(s // 3600 * 10000 + s % 3600 // 60 * 100 + s % 60 AS INTEGER) AS time_key,
    printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS full_time,
    s // 3600 AS "hour", s % 3600 // 60 AS "minute", s % 60 AS "second"
  FROM range(86400) AS all_seconds(s)
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def usage(dimension: str, columns: str, key_column: str, trip_key: str, trips: str = "trips") -> str:
    return f"""
SELECT {columns}, CAST(coalesce(n, 0) AS BIGINT) AS trips
FROM {dimension}
LEFT JOIN (SELECT {trip_key} AS k, count(*) AS n FROM {trips} GROUP BY 1) ON k = {key_column}"""


def union(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


_VENDOR_ERROR = """
errors AS (
  SELECT vendor_id, count(*) AS trips,
    sqrt(avg(CAST(power(total_amount - (fare_amount + 3 * vendor_id), 2) AS DOUBLE))) AS rmse
  FROM fact GROUP BY vendor_id
)"""



def as_double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def as_bigint(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


def as_text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


_FACT_KEYS = [
    "vendor_id",
    "ratecode_id",
    "payment_type_id",
    "pu_location_id",
    "do_location_id",
    "pu_date_key",
    "do_date_key",
    "pu_time_key",
    "do_time_key",
]
_FEATURES = [
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "fare_amount",
    "extra",
    "tip_amount",
    "trip_distance",
]
_MONTH_TRIPS = """
monthly AS (
  SELECT *, CAST(CASE WHEN event_id % 24 < 12 THEN 2023 ELSE 2024 END AS BIGINT) AS "year",
    CAST(1 + event_id % 12 AS BIGINT) AS "month"
  FROM trips
)"""
_FILE_NAMES = r"""
names AS (
  SELECT event_id, CASE
      WHEN event_id % 11 = 0 THEN 'trips' || (2020 + event_id % 5) || '-01.parquet'
      WHEN event_id % 13 = 0 THEN 'trips_' || (2020 + event_id % 5) || '-01.parquet.bak'
      WHEN event_id % 17 = 0 THEN 'trips_' || (2020 + event_id % 5) || '-' || (event_id % 9) || '.parquet'
      ELSE 'in/trips_' || (2020 + event_id % 5) || '-' || lpad(CAST(event_id % 15 AS VARCHAR), 2, '0') || '.parquet'
    END AS name
  FROM events
),
periods AS (
  SELECT event_id, regexp_extract(name, '^.*_(\d{4})-(\d{2})\.parquet$', 1) AS "year",
    regexp_extract(name, '^.*_(\d{4})-(\d{2})\.parquet$', 2) AS "month"
  FROM names
)"""
_TABLE_ROWS = """
SELECT 'dim_vendor' AS table_name, 5 AS n UNION ALL SELECT 'dim_ratecode', 7
UNION ALL SELECT 'dim_payment_type', 7 UNION ALL SELECT 'dim_store_and_fwd', 2
UNION ALL SELECT 'dim_zone', 265 UNION ALL SELECT 'dim_date', 367 UNION ALL SELECT 'dim_time', 86400
UNION ALL SELECT 'fact_trip', (SELECT count(*) FROM fact)"""
_MODEL_RANGES = [
    ("PULocationID", "PULocationID BETWEEN 1 AND 300"),
    ("DOLocationID", "DOLocationID BETWEEN 1 AND 300"),
    ("passenger_count", "passenger_count BETWEEN 1 AND 4"),
    ("fare_amount", "fare_amount BETWEEN -50 AND 50"),
    ("extra", "extra BETWEEN 0 AND 15"),
    ("tip_amount", "tip_amount BETWEEN 0 AND 15"),
    ("trip_distance", "trip_distance BETWEEN 0 AND 500"),
]
_FK = [
    ("vendor_id", "vendors", "vendor_id"),
    ("ratecode_id", "ratecodes", "ratecode_id"),
    ("payment_type_id", "payment_types", "payment_type_id"),
    ("store_and_fwd_flag", "flags", "store_and_fwd_flag"),
    ("pu_location_id", "zones", "location_id"),
    ("do_location_id", "zones", "location_id"),
    ("pu_date_key", "days", "date_key"),
    ("do_date_key", "days", "date_key"),
    ("pu_time_key", "seconds", "time_key"),
    ("do_time_key", "seconds", "time_key"),
]
_SPLIT = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 6) AS BIGINT) % 100 < 20"
_SNAPSHOT = with_(TRIPS) + f"SELECT {as_double(*_FEATURES, 'total_amount')} FROM trips"

SQL = {
    # sources
    "raw_scan": "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events",
    "file_period": with_(_FILE_NAMES)
    + """SELECT event_id, "year", "month", "month" BETWEEN '01' AND '12' AS period_valid FROM periods""",
    "partitioned_scan": with_(TRIPS, _MONTH_TRIPS)
    + f"""SELECT event_id, "year", "month", {as_double("trip_distance", "fare_amount")}
FROM monthly""",
    "month_list_scan": with_(TRIPS, _MONTH_TRIPS)
    + f"""SELECT event_id, "year", "month", {as_double("trip_distance", "fare_amount")}
FROM monthly WHERE "year" = 2024 AND "month" IN (1, 3, 11)""",
    "mixed_schema_scan": with_(TRIPS, _MONTH_TRIPS)
    + """SELECT "year", "month", count(*) AS trips, CAST(sum(passenger_count) AS DOUBLE) AS passengers,
  sum(CAST(airport_fee AS DECIMAL(10,2)))::DOUBLE AS airport_fees,
  sum(CASE WHEN "month" % 4 = 2 THEN 0 ELSE 0.75 END)::DOUBLE AS cbd_fees
FROM monthly GROUP BY "year", "month" """,
    "zone_scan": with_(TRIPS, ZONES)
    + usage("zones", "location_id, borough, zone_name, service_zone", "location_id", "PULocationID"),
    # dimensions
    "dim_vendor": with_(TRIPS, VENDORS) + usage("vendors", "vendor_id, vendor_name", "vendor_id", "VendorID"),
    "dim_ratecode": with_(TRIPS, RATECODES)
    + usage("ratecodes", "ratecode_id, ratecode_label", "ratecode_id", "RatecodeID"),
    "dim_payment_type": with_(TRIPS, PAYMENT_TYPES)
    + usage("payment_types", "payment_type_id, payment_type_label", "payment_type_id", "payment_type"),
    "dim_store_and_fwd": with_(TRIPS, CONFORMED, FLAGS)
    + usage("flags", "store_and_fwd_flag, label", "store_and_fwd_flag", "store_and_fwd_flag", "conformed"),
    "dim_date": with_(
        TRIPS,
        CONFORMED,
        calendar(
            "days",
            "(SELECT min(CAST(pickup AS DATE)) FROM trips)",
            "(SELECT max(CAST(pickup AS DATE)) FROM trips)",
        ),
    )
    + usage(
        "days",
        'date_key, CAST(full_date AS VARCHAR) AS full_date, "year", "month", "day", day_of_week, is_weekend',
        "date_key",
        "pu_date_key",
        "conformed",
    ),
    "dim_time": with_(TRIPS, CONFORMED, SECONDS)
    + usage(
        "seconds", 'time_key, full_time, "hour", "minute", "second"', "time_key", "pu_time_key", "conformed"
    ),
    # columns
    "add_missing_columns": with_(TRIPS)
    + "SELECT event_id, airport_fee, 0.0::DOUBLE AS cbd_congestion_fee FROM trips",
    "fact_trip": with_(TRIPS, FACT)
    + f"""SELECT event_id, {as_bigint(*_FACT_KEYS)}, store_and_fwd_flag,
  {as_text("pickup_datetime", "dropoff_datetime")}, {as_bigint("passenger_count")},
  {as_double("trip_distance", *MONEY)} FROM fact""",
    "feature_select": with_(TRIPS)
    + f"""SELECT {as_double(*_FEATURES, "total_amount")}, CAST(pickup AS VARCHAR) AS tpep_pickup_datetime,
  CAST(dropoff AS VARCHAR) AS tpep_dropoff_datetime FROM trips""",
    "feature_target": with_(TRIPS)
    + f"SELECT event_id, {as_double(*_FEATURES)}, total_amount AS label FROM trips",
    # rules
    "trips_accepted": with_(TRIPS, FACT)
    + f"""SELECT t.event_id, CAST(pickup AS VARCHAR) AS pickup, CAST(t.passenger_count AS DOUBLE) AS passenger_count,
  {", ".join(f"CAST(t.{c} AS DOUBLE) AS {c}" for c in ("trip_distance", "extra", "fare_amount", "total_amount"))}
FROM trips t JOIN fact f ON f.event_id = t.event_id""",
    "trips_rejected": with_(TRIPS)
    + "SELECT * FROM (SELECT event_id, CASE "
    + " ".join(f"WHEN NOT coalesce({condition}, false) THEN '{name}'" for name, condition in RULES)
    + " END AS reject_reason FROM trips) WHERE reject_reason IS NOT NULL",
    "reject_counts": with_(TRIPS)
    + union(
        *[
            f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({condition}, false)) AS failed FROM trips"
            for name, condition in RULES
        ]
    ),
    # functions
    "date_time_keys": with_(TRIPS, CONFORMED)
    + f"""SELECT event_id, {as_double("pu_date_key", "do_date_key", "pu_time_key", "do_time_key")}
FROM conformed""",
    "flag_normalise": with_(TRIPS, CONFORMED) + "SELECT event_id, store_and_fwd_flag FROM conformed",
    "safe_narrowing": """SELECT l_orderkey, l_linenumber, CAST(TRY_CAST(l_orderkey AS SMALLINT) AS DOUBLE) AS narrowed,
  l_orderkey BETWEEN -32768 AND 32767 AS fits FROM lineitem""",
    "money_cast": with_(TRIPS, CONFORMED)
    + f"SELECT event_id, {as_double('trip_distance', 'fare_amount', 'total_amount')} FROM conformed",
    "hhmmss_to_seconds": """SELECT event_id, CAST(strftime(ts, '%H%M%S') AS BIGINT) AS packed,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS seconds FROM events""",
    # keys and audits
    "assign_trip_id": with_(TRIPS, FACT)
    + """SELECT event_id, row_number() OVER (ORDER BY event_id) AS trip_id,
  CAST(total_amount AS DOUBLE) AS total_amount FROM fact""",
    "pk_audit": with_(TRIPS, FACT, ZONES)
    + """SELECT 'lineitem' AS table_name, 'primary_key' AS constraint_name,
  l_orderkey || '|' || l_linenumber AS key_value, count(*) AS row_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'orders', 'primary_key', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey
HAVING count(*) > 1
UNION ALL
SELECT 'events', 'primary_key', CAST(event_id AS VARCHAR), count(*) FROM events GROUP BY event_id
HAVING count(*) > 1
UNION ALL
SELECT 'fact_badly', 'primary_key', CAST(event_id // 500 AS VARCHAR), count(*) FROM fact GROUP BY event_id // 500
HAVING count(*) > 1
UNION ALL
SELECT 'dim_zone', 'unique', zone_name, count(*) FROM zones GROUP BY zone_name HAVING count(*) > 1""",
    "not_null_audit": with_(
        TRIPS, CONFORMED, VENDORS, RATECODES, PAYMENT_TYPES, FLAGS, ZONES, YEAR_CALENDAR, SECONDS
    )
    + union(
        *[
            f"SELECT 'raw_trip' AS table_name, '{shown}' AS column_name, count(*) - count({c}) AS missing FROM trips"
            for shown, c in [
                ("tpep_pickup_datetime", "pickup"),
                ("tpep_dropoff_datetime", "dropoff"),
                *[
                    (c, c)
                    for c in (
                        "VendorID",
                        "RatecodeID",
                        "store_and_fwd_flag",
                        "PULocationID",
                        "DOLocationID",
                        "payment_type",
                        *MEASURES,
                    )
                ],
            ]
        ],
        *[
            f"SELECT 'fact_trip', '{c}', count(*) - count({c}) FROM conformed"
            for c in (*_FACT_KEYS, "store_and_fwd_flag", "pickup_datetime", "dropoff_datetime", *MEASURES)
        ],
        *[
            f"SELECT '{table}', '{c}', count(*) - count(\"{c}\") FROM {source}"
            for table, source, required in [
                ("dim_vendor", "vendors", ("vendor_id", "vendor_name")),
                ("dim_ratecode", "ratecodes", ("ratecode_id", "ratecode_label")),
                ("dim_payment_type", "payment_types", ("payment_type_id",)),
                ("dim_store_and_fwd", "flags", ("store_and_fwd_flag", "label")),
                ("dim_zone", "zones", ("location_id",)),
                ("dim_date", "days", ("date_key", "full_date", "year", "month", "day", "day_of_week", "is_weekend")),
                ("dim_time", "seconds", ("time_key", "full_time", "hour", "minute", "second")),
            ]
            for c in required
        ],
    ),
    "check_audit": with_(
        TRIPS,
        CONFORMED,
        FLAGS,
        YEAR_CALENDAR,
        calendar(
            "pickup_days",
            "(SELECT min(CAST(pickup AS DATE)) FROM trips)",
            "(SELECT max(CAST(pickup AS DATE)) FROM trips)",
        ),
        SECONDS,
    )
    + union(
        *[
            f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
            f"count(*) FILTER (WHERE NOT ({condition})) AS violations FROM {source}"
            for table, source, name, condition in [
                ("fact_trip", "conformed", "flag_is_y_or_n", "store_and_fwd_flag IN ('Y', 'N')"),
                *[("fact_trip", "conformed", f"{c}_not_negative", f"{c} >= 0") for c in MEASURES],
                (
                    "fact_trip",
                    "conformed",
                    "dropoff_not_before_pickup",
                    "dropoff_datetime >= pickup_datetime",
                ),
                ("dim_store_and_fwd", "flags", "flag_is_y_or_n", "store_and_fwd_flag IN ('Y', 'N')"),
                *[
                    (table, source, name, condition)
                    for table, source in (("dim_date", "days"), ("pickup_calendar", "pickup_days"))
                    for name, condition in (
                        ("month_in_range", '"month" BETWEEN 1 AND 12'),
                        ("day_in_range", '"day" BETWEEN 1 AND 31'),
                        ("day_of_week_in_range", "day_of_week BETWEEN 1 AND 7"),
                    )
                ],
                ("dim_time", "seconds", "hour_in_range", '"hour" BETWEEN 0 AND 23'),
                ("dim_time", "seconds", "minute_in_range", '"minute" BETWEEN 0 AND 59'),
                ("dim_time", "seconds", "second_in_range", '"second" BETWEEN 0 AND 59'),
            ]
        ]
    ),
    "fk_audit": with_(TRIPS, FACT, VENDORS, RATECODES, PAYMENT_TYPES, FLAGS, ZONES, YEAR_CALENDAR, SECONDS)
    + union(
        *[
            f"SELECT '{column}' AS foreign_key, CAST({column} AS VARCHAR) AS key_value, count(*) AS row_count "
            f"FROM fact WHERE {column} NOT IN (SELECT {target} FROM {table}) GROUP BY {column}"
            for column, table, target in _FK
        ]
    ),
    # sinks
    "append_month": with_(TRIPS, _MONTH_TRIPS)
    + """SELECT "year", "month", CAST(2 * count(*) AS BIGINT) AS trips FROM monthly GROUP BY "year", "month" """,
    "land_files_month": with_(TRIPS)
    + """SELECT CAST(2024 AS BIGINT) AS "year", CAST(event_id % 3 + 1 AS BIGINT) AS "month", count(*) AS trips,
  count(DISTINCT event_id) AS events, CAST(sum(passenger_count) AS DOUBLE) AS passengers,
  CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DOUBLE) AS revenue,
  CAST(sum(CASE WHEN event_id % 3 = 1 AND event_id // 3 % 2 = 1 THEN 0 ELSE 0.75 END) AS DOUBLE) AS cbd_fees
FROM trips GROUP BY event_id % 3""",
    "replace_month": with_(TRIPS, _MONTH_TRIPS)
    + """SELECT "year", "month", count(*) AS trips,
  sum(CASE WHEN "year" = 2024 THEN 6.25 ELSE 0 END)::DOUBLE AS tolls
FROM monthly GROUP BY "year", "month" """,
    "jdbc_staging": with_(TRIPS, FACT)
    + "SELECT CAST(8 AS BIGINT) AS writers, count(*) AS trips, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact",
    "snapshot_parquet": _SNAPSHOT,
    "snapshot_csv": _SNAPSHOT,
    "write_verify": with_(TRIPS)
    + """SELECT count(*) AS rows_given, count(*) AS rows_written, true AS good, false AS same_if_changed,
  count(DISTINCT event_id) AS events, CAST(sum(CAST(total_amount AS DECIMAL(18,6))) AS DOUBLE) AS revenue FROM trips""",
    "truncate_reload": with_(TRIPS, FACT, f"sizes AS ({_TABLE_ROWS})")
    + """SELECT table_name, CAST(n AS BIGINT) AS rows_before, CAST(CASE table_name WHEN 'fact_trip' THEN 0 ELSE n END
  AS BIGINT) AS rows_after FROM sizes""",
    "recreate_tables": with_(TRIPS, FACT, f"sizes AS ({_TABLE_ROWS})")
    + "SELECT table_name, CAST(n AS BIGINT) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM sizes",
    "insert_or_ignore": with_(TRIPS, ZONES)
    + """SELECT CAST(location_id AS DOUBLE) AS location_id, borough AS label FROM zones WHERE borough = 'ASIA'
UNION ALL
SELECT CAST(DOLocationID AS DOUBLE), 'trip ' || min(event_id) FROM trips
WHERE DOLocationID IS NULL OR DOLocationID NOT IN (SELECT location_id FROM zones WHERE borough = 'ASIA') GROUP BY 1""",
    "warehouse_load": with_(TRIPS, FACT)
    + """SELECT CAST(pu_date_key AS BIGINT) AS pu_date_key, count(*) AS trips, count(*) AS identities,
  CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact GROUP BY 1""",
    "arrivals_load": with_(TRIPS, FACT)
    + """SELECT CAST(vendor_id AS BIGINT) AS vendor_id, count(*) AS trips,
  CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact GROUP BY 1""",
    # model
    "rmse": with_(TRIPS, FACT, _VENDOR_ERROR)
    + "SELECT CAST(vendor_id AS BIGINT) AS vendor_id, trips, round(rmse, 4) AS rmse FROM errors",
    "model_gate": with_(TRIPS, FACT, _VENDOR_ERROR)
    + """SELECT CAST(vendor_id AS BIGINT) AS vendor_id, round(rmse, 4) AS rmse,
  rmse < 10 AS saved FROM errors""",
    "train_test_split": f"SELECT event_id, {_SPLIT} AS is_test FROM events",
    "snapshot_split": with_(TRIPS, _MONTH_TRIPS)
    + """SELECT count(*) AS rows, count(*) AS keys, CAST(0 AS BIGINT) AS moved, true AS about_a_fifth
FROM monthly WHERE "year" = 2024""",
    # Of a fitted model: what must hold whatever it predicts.
    "rf_train_metrics": with_(TRIPS)
    + """SELECT count(*) AS trips, count(total_amount) AS labelled, round(stddev_pop(total_amount), 4) AS label_spread,
  true AS better_than_half_the_spread, true AS saved_if_good, CAST(100 AS BIGINT) AS trees FROM trips""",
    "rf_predict": with_(TRIPS) + f"SELECT event_id, total_amount AS label, true AS in_range FROM trips WHERE {_SPLIT}",
    "model_roundtrip": with_(TRIPS)
    + f"""SELECT CAST(passenger_count AS DOUBLE) AS passenger_count, count(*) AS trips, count(DISTINCT event_id) AS events,
  CAST(0 AS BIGINT) AS differing FROM trips WHERE {_SPLIT} GROUP BY 1""",
    "batch_score": with_(TRIPS)
    + "SELECT event_id, CASE "
    + " ".join(f"WHEN NOT coalesce({condition}, false) THEN '{c}_in_range'" for c, condition in _MODEL_RANGES)
    + " ELSE '' END AS input_problem, true AS in_range FROM trips",
    "score_input_check": with_(TRIPS)
    + "SELECT event_id, CASE "
    + " ".join(f"WHEN NOT coalesce({condition}, false) THEN '{c}_in_range'" for c, condition in _MODEL_RANGES)
    + " ELSE '' END AS input_problem FROM trips",
    # implied
    # Dates and times follow from the trip itself; the calendar ends a day after its year.
    "star_view": with_(TRIPS, CONFORMED, VENDORS, RATECODES, PAYMENT_TYPES, FLAGS, ZONES)
    + f""", named AS MATERIALIZED (
  SELECT event_id, vendor_name, ratecode_label, payment_type_label, flags.label AS store_and_fwd_label,
    pu_location_id, do_location_id, pickup_datetime, dropoff_datetime, total_amount
  FROM (SELECT * FROM conformed WHERE accepted) fact LEFT JOIN vendors USING (vendor_id) LEFT JOIN ratecodes USING (ratecode_id)
  LEFT JOIN payment_types USING (payment_type_id) LEFT JOIN flags ON flags.store_and_fwd_flag = fact.store_and_fwd_flag
), listed AS MATERIALIZED (
  SELECT * FROM zones
)
SELECT event_id, vendor_name, ratecode_label, payment_type_label, store_and_fwd_label,
  pz.borough AS pu_borough, pz.zone_name AS pu_zone_name, dz.zone_name AS do_zone_name,
  dz.service_zone AS do_service_zone,
  CASE WHEN {_IN_CALENDAR.format("pickup_datetime")} THEN strftime(pickup_datetime, '%Y-%m-%d') END AS pu_full_date,
  CASE WHEN {_IN_CALENDAR.format("dropoff_datetime")} THEN CAST(isodow(dropoff_datetime) AS DOUBLE) END AS do_day_of_week,
  strftime(pickup_datetime, '%H:%M:%S') AS pu_full_time, strftime(dropoff_datetime, '%H:%M:%S') AS do_full_time,
  CAST(total_amount AS DOUBLE) AS total_amount
FROM named LEFT JOIN listed pz ON pz.location_id = pu_location_id LEFT JOIN listed dz ON dz.location_id = do_location_id""",
    "weekday_revenue": with_(TRIPS, FACT, YEAR_CALENDAR)
    + """SELECT CAST(day_of_week AS BIGINT) AS day_of_week, is_weekend, count(*) AS trips,
  CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fact JOIN days ON date_key = pu_date_key GROUP BY 1, 2""",
}
