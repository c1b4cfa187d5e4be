"""The named queries: every operator over the whole of the given tables.

Each takes (spark, sf_dir). Results are flattened for comparison: decimals as doubles,
dates and timestamps as text, whole numbers as bigint, or as double where they may be missing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.functions import hhmmss_seconds, narrow, time_key
from meterline.operators import (
    audits,
    columns,
    dimensions,
    fact,
    forest,
    metrics,
    numbering,
    rules,
    star,
    upsert,
)
from meterline.plans import landing, loading, training
from meterline.session import scratch_path, shared_path
from meterline.sinks import jdbc, months, snapshots, tables
from meterline.sources import trips as trip_files
from meterline.sources.derived import YEAR, trips_from_events, zones_from_places
from meterline.sources.zones import read_zones
from meterline.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

def fitting_memory(spark: SparkSession, rows: int, trees: int = forest.TREES) -> int:
    """MB of split statistics per running task while `trees` of the queries' forest are fitted at once: the
    usual 256, or what a small session has. It changes the number of passes over the rows, not the model.

    A session too small for the trees themselves is told so, before it dies of them.
    """
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() >> 20
    # A tree has two nodes per row at most, and as many as its depth allows; a node takes half a KB.
    held = trees * min(2 * rows, 2 ** (forest.DEPTH + 1)) >> 11
    if 2 * held > heap:
        raise MemoryError(f"the forest's trees take {held} MB of the session's heap of {heap} MB")
    return min(256, max(16, heap // 32))


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def flat(df: DataFrame, *nullable: str) -> DataFrame:
    def shown(field: T.StructField) -> str:
        name, kind = field.name, field.dataType
        if name in nullable or isinstance(kind, (T.DecimalType, T.FloatType)):
            return f"CAST({name} AS DOUBLE) AS {name}"
        if isinstance(kind, T.IntegralType):
            return f"CAST({name} AS BIGINT) AS {name}"
        if isinstance(kind, (T.DateType, T.TimestampNTZType)):
            return f"CAST({name} AS STRING) AS {name}"
        return name

    return df.selectExpr(*map(shown, df.schema))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return trip_files.read_file(spark, f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder that `write` fills, written once per application: inputs the queries share."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not trip_files.exists(spark, _STORED[key]):
        _STORED[key] = scratch_path(spark, name)
        write(_STORED[key])
    return _STORED[key]


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips derived from the events, as the raw Parquet files that trips come in."""

    def write(path: str) -> None:
        trips_from_events(table(spark, sf_dir, "events")).write.parquet(path)

    return trip_files.read_file(spark, stored(spark, sf_dir, "raw_trips", write))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.fact_rows(raw_trips(spark, sf_dir), YEAR, "event_id")


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.conform(columns.complete_raw(raw_trips(spark, sf_dir)), "event_id")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension, through its CSV file."""

    def write(path: str) -> None:
        region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
        snapshots.write_csv(zones_from_places(spark, region, nation), path)

    return read_zones(spark, stored(spark, sf_dir, "zones", write))


def all_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dimensions.seed_dimensions(spark, zones(spark, sf_dir), YEAR)


# ---- sources


@query
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(table(spark, sf_dir, "events"))


@query
def file_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    year = (2020 + event % 5).cast("string")
    month = F.lpad((event % 15).cast("string"), 2, "0")
    name = (
        F.when(event % 11 == 0, F.concat(F.lit("trips"), year, F.lit("-01.parquet")))
        .when(event % 13 == 0, F.concat(F.lit("trips_"), year, F.lit("-01.parquet.bak")))
        .when(event % 17 == 0, F.concat(F.lit("trips_"), year, F.lit("-"), event % 9, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("in/trips_"), year, F.lit("-"), month, F.lit(".parquet")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", *[column.alias(key) for key, column in trip_files.period_columns(name).items()]
    )


def monthly(trips: DataFrame) -> DataFrame:
    """Trips with the month they are landed under."""
    event = F.col("event_id")
    return trips.withColumns(
        {
            "year": F.when(event % 24 < 12, "2023").otherwise("2024"),
            "month": F.lpad((1 + event % 12).cast("string"), 2, "0"),
        }
    )


def land_all(spark: SparkSession, sf_dir: str, root: str) -> None:
    months.append_month(monthly(raw_trips(spark, sf_dir)), root)


def landed(spark: SparkSession, sf_dir: str) -> str:
    """The landed tree that queries share to read from."""
    return stored(spark, sf_dir, "landed", lambda root: land_all(spark, sf_dir, root))


@query
def partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landed(spark, sf_dir)
    rows = trip_files.read_year(spark, root, 2023).unionByName(trip_files.read_year(spark, root, 2024))
    return flat(rows.select("event_id", "year", "month", "trip_distance", "fare_amount"))


@query
def month_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trip_files.read_months(spark, landed(spark, sf_dir), 2024, [1, 3, 11])
    return flat(rows.select("event_id", "year", "month", "trip_distance", "fare_amount"))


@query
def mixed_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that lack a column beside months that store a count as a fraction."""
    root = scratch_path(spark, "mixed")
    trips = monthly(raw_trips(spark, sf_dir))
    kind = F.col("month").cast("int") % 4
    months.append_month(trips.filter(kind.isin(0, 1)), root)
    months.append_month(trips.filter(kind == 2).drop("cbd_congestion_fee"), root)
    fractions = trips.filter(kind == 3).withColumn("passenger_count", F.col("passenger_count").cast("double"))
    months.append_month(fractions, root)
    years = [columns.complete_raw(trip_files.read_year(spark, root, year)) for year in (2023, 2024)]
    rows = years[0].unionByName(years[1])
    amount = {name: F.coalesce(name, F.lit(0.0)).cast(schema.MONEY) for name in schema.OPTIONAL_RAW_COLUMNS}
    return flat(
        rows.groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum(F.col("passenger_count").cast("double")).alias("passengers"),
            F.sum(amount["airport_fee"]).alias("airport_fees"),
            F.sum(amount["cbd_congestion_fee"]).alias("cbd_fees"),
        )
    )


@query
def zone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw_trips(spark, sf_dir)
    return flat(dimensions.usage(zones(spark, sf_dir), "location_id", trips, "PULocationID"))


# ---- dimensions


@query
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(dimensions.usage(dimensions.vendors(spark), "vendor_id", raw_trips(spark, sf_dir), "VendorID"))


@query
def dim_ratecode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(dimensions.usage(dimensions.ratecodes(spark), "ratecode_id", raw_trips(spark, sf_dir), "RatecodeID"))


@query
def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = dimensions.payment_types(spark)
    return flat(dimensions.usage(types, "payment_type_id", raw_trips(spark, sf_dir), "payment_type"))


@query
def dim_store_and_fwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = dimensions.store_and_fwd_flags(spark)
    return flat(dimensions.usage(flags, "store_and_fwd_flag", conformed(spark, sf_dir), "store_and_fwd_flag"))


def pickup_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = raw_trips(spark, sf_dir).selectExpr(f"CAST({schema.PICKUP} AS DATE) AS day")
    return dimensions.calendar_spanning(days, "day")


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = pickup_calendar(spark, sf_dir)
    return flat(dimensions.usage(days, "date_key", conformed(spark, sf_dir), "pu_date_key"))


@query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = dimensions.day_seconds(spark)
    return flat(dimensions.usage(seconds, "time_key", conformed(spark, sf_dir), "pu_time_key"))


# ---- columns


@query
def add_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = raw_trips(spark, sf_dir).drop("cbd_congestion_fee")
    return columns.complete_raw(older).select("event_id", "airport_fee", "cbd_congestion_fee")


@query
def fact_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(facts(spark, sf_dir))


@query
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(columns.model_columns(raw_trips(spark, sf_dir)), *schema.FEATURES)


@query
def feature_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.features_and_label(columns.training_columns(raw_trips(spark, sf_dir), "event_id"), "event_id")


# ---- rules


@query
def trips_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rules.accept(columns.complete_raw(raw_trips(spark, sf_dir)), rules.trip_rules(YEAR))
    shown = kept.select(
        "event_id",
        F.col(schema.PICKUP).alias("pickup"),
        "passenger_count",
        "trip_distance",
        "extra",
        "fare_amount",
        "total_amount",
    )
    return flat(shown, "passenger_count")


@query
def trips_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned_away = rules.reject(columns.complete_raw(raw_trips(spark, sf_dir)), rules.trip_rules(YEAR))
    return turned_away.select("event_id", "reject_reason")


@query
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.count_failures(columns.complete_raw(raw_trips(spark, sf_dir)), rules.trip_rules(YEAR))


# ---- functions


@query
def date_time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["pu_date_key", "do_date_key", "pu_time_key", "do_time_key"]
    return flat(conformed(spark, sf_dir).select("event_id", *keys), *keys)


@query
def flag_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(spark, sf_dir).select("event_id", "store_and_fwd_flag")


@query
def safe_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = narrow("l_orderkey", "smallint")
    lines = table(spark, sf_dir, "lineitem")
    shown = lines.selectExpr("l_orderkey", "l_linenumber", f"{small} AS narrowed", f"{small} IS NOT NULL AS fits")
    return flat(shown, "narrowed")


@query
def money_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(conformed(spark, sf_dir).select("event_id", "trip_distance", "fare_amount", "total_amount"))


@query
def hhmmss_to_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "events").selectExpr("event_id", f"{time_key('ts')} AS packed")
    return flat(packed.selectExpr("event_id", "packed", f"{hhmmss_seconds('packed')} AS seconds"))


# ---- keys and audits


@query
def assign_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = numbering.assign_ids(facts(spark, sf_dir), ["event_id"])
    return flat(numbered.select("event_id", "trip_id", "total_amount"))


@query
def pk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [
        audits.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        audits.duplicate_keys(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
        audits.duplicate_keys(table(spark, sf_dir, "events"), ["event_id"], "events"),
        audits.duplicate_keys(zones(spark, sf_dir), ["zone_name"], "dim_zone", "unique"),
        audits.table_key_audit(all_dimensions(spark, sf_dir)),
        audits.duplicate_keys(numbering.sparse_ids(facts(spark, sf_dir)), ["trip_id"], "fact_trip"),
        # Numbered badly, so that the audit of the facts' key has something to find.
        audits.duplicate_keys(facts(spark, sf_dir).selectExpr("event_id DIV 500 AS trip_id"), ["trip_id"], "fact_badly"),
    ]
    return reduce(DataFrame.unionByName, found)


@query
def not_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = columns.complete_raw(raw_trips(spark, sf_dir))
    required = [name for name in audits.required_columns(schema.FACT_TRIP) if name != "trip_id"]
    found = [
        audits.missing_values(raw, schema.RAW_TRIP.names, "raw_trip"),
        audits.missing_values(conformed(spark, sf_dir), required, "fact_trip"),
    ]
    for name, dimension in all_dimensions(spark, sf_dir).items():
        found.append(audits.missing_values(dimension, audits.required_columns(schema.TABLES[name]), name))
    return reduce(DataFrame.unionByName, found)


@query
def check_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared CHECKs on every trip and on the dimensions as they are seeded; and on the calendar
    of all pickups."""
    tables_ = {"fact_trip": conformed(spark, sf_dir), **all_dimensions(spark, sf_dir)}
    found = [rules.count_violations(tables_[name], checks, name) for name, checks in audits.table_checks().items()]
    found.append(rules.count_violations(pickup_calendar(spark, sf_dir), audits.calendar_checks(), "pickup_calendar"))
    return reduce(DataFrame.unionByName, found)


@query
def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.orphans(facts(spark, sf_dir), all_dimensions(spark, sf_dir))


# ---- sinks


@query
def append_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows landed twice are there twice."""
    root = scratch_path(spark, "append")
    trips = monthly(raw_trips(spark, sf_dir))
    months.append_month(trips, root)
    months.append_month(trips, root)
    return flat(spark.read.parquet(root).groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips")))


@query
def land_files_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that come in several files of other columns and types, landed twice by the run."""
    files, root = scratch_path(spark, "files"), scratch_path(spark, "landed")
    trips = raw_trips(spark, sf_dir).withColumnRenamed("airport_fee", "Airport_fee")
    event, paths = F.col("event_id"), []
    for month in range(3):
        for part in range(2):
            rows = trips.filter((event % 3 == month) & (F.floor(event / 3) % 2 == part))
            if part:
                rows = rows.withColumn("passenger_count", F.col("passenger_count").cast("double"))
                rows = rows.drop("cbd_congestion_fee") if month == 1 else rows
            paths.append(f"{files}/{part}/trips_2024-{month + 1:02d}.parquet")
            rows.write.parquet(paths[-1])
    for _ in range(2):
        landing.land_files(spark, paths, root)
    rows = columns.complete_raw(trip_files.read_year(spark, root, 2024))
    money = {name: F.coalesce(name, F.lit(0.0)).cast(schema.MONEY) for name in ("total_amount", "cbd_congestion_fee")}
    return flat(
        rows.groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("trips"),
            F.countDistinct("event_id").alias("events"),
            F.sum("passenger_count").alias("passengers"),
            F.sum(money["total_amount"]).alias("revenue"),
            F.sum(money["cbd_congestion_fee"]).alias("cbd_fees"),
        )
    )


@query
def replace_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of one year replaced twice are there once, and the other year's stay."""
    root = scratch_path(spark, "replaced")
    land_all(spark, sf_dir, root)
    newer = monthly(raw_trips(spark, sf_dir)).filter(F.col("year") == "2024").withColumn("tolls_amount", F.lit(6.25))
    months.replace_month(newer, root)
    months.replace_month(newer, root)
    tolls = F.sum(F.col("tolls_amount").cast(schema.MONEY)).alias("tolls")
    return flat(spark.read.parquet(root).groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"), tolls))


@query
def jdbc_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows as the database writers get them."""
    dealt = jdbc.staged(facts(spark, sf_dir)).withColumn("writer", F.spark_partition_id())
    per_writer = dealt.groupBy("writer").agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue"))
    return flat(
        per_writer.agg(
            F.count("writer").alias("writers"), F.sum("trips").alias("trips"), F.sum("revenue").alias("revenue")
        )
    )


@query
def snapshot_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshot")
    snapshots.write_parquet(columns.training_columns(raw_trips(spark, sf_dir)), path)
    return flat(spark.read.parquet(path), *schema.FEATURES)


@query
def snapshot_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "snapshot")
    rows = columns.training_columns(raw_trips(spark, sf_dir))
    snapshots.write_csv(rows, path)
    return flat(spark.read.csv(path, schema=rows.schema, header=True), *schema.FEATURES)


@query
def write_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the check after a write reports, beside what the written rows add up to; and that the
    check's sum tells a table from one with a single cent more in one row."""
    trips, path = raw_trips(spark, sf_dir), scratch_path(spark, "verified")
    report = snapshots.write_verified(trips, path)
    written = spark.read.parquet(path)
    first = trips.agg(F.min("event_id")).first()[0]
    changed = F.when(F.col("event_id") == first, F.col("tip_amount") + 0.01).otherwise(F.col("tip_amount"))
    other = written.withColumn("tip_amount", changed)
    sums = [frame.agg(snapshots.checksum(frame)).first()[0] for frame in (written, other)]
    return flat(
        written.agg(
            F.lit(report.rows_given).alias("rows_given"),
            F.lit(report.rows_written).alias("rows_written"),
            F.lit(report.good).alias("good"),
            F.lit(sums[0] == sums[1]).alias("same_if_changed"),
            F.countDistinct("event_id").alias("events"),
            F.sum(F.col("total_amount").cast("decimal(18,6)")).alias("revenue"),
        )
    )


def warehouse(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All eight tables, made and filled; and the zones they were filled with."""
    root, places = scratch_path(spark, "warehouse"), zones(spark, sf_dir)
    tables.recreate_tables(spark, root)
    loading.load_dimensions(spark, root, places, YEAR)
    tables.append_table(numbering.sparse_ids(facts(spark, sf_dir)), root, "fact_trip")
    return root, places


def table_sizes(spark: SparkSession, root: str, into: str) -> DataFrame:
    sizes = [
        rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias(into))
        for name, rows in tables.read_tables(spark, root).items()
    ]
    return reduce(DataFrame.unionByName, sizes)


def before_and_after(spark: SparkSession, root: str, change: Callable[[], None]) -> DataFrame:
    """Rows per table before and after `change`; the sizes before are taken first, as eight rows."""
    before = table_sizes(spark, root, "rows_before").collect()
    change()
    return spark.createDataFrame(before).join(table_sizes(spark, root, "rows_after"), "table_name")


@query
def truncate_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones reloaded, with the facts emptied because they are named."""
    root, places = warehouse(spark, sf_dir)
    return before_and_after(
        spark, root, lambda: tables.truncate_and_reload(spark, root, {"dim_zone": places}, ["fact_trip"])
    )


@query
def recreate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = warehouse(spark, sf_dir)
    return before_and_after(spark, root, lambda: tables.recreate_tables(spark, root))


@query
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones named after their first trip; those of one borough are held already, under its name."""
    held = zones(spark, sf_dir).filter("borough = 'ASIA'")
    held = held.selectExpr("CAST(location_id AS BIGINT) AS location_id", "borough AS label")
    batch = raw_trips(spark, sf_dir).select(
        F.col("DOLocationID").cast("bigint").alias("location_id"),
        F.concat(F.lit("trip "), F.col("event_id")).alias("label"),
        "event_id",
    )
    return flat(upsert.insert_or_ignore(held, batch, ["location_id"], ["event_id"]), "location_id")


@query
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips landed, then loaded year by year, one month of them twice: per pickup day, with the
    identities told apart."""
    root = scratch_path(spark, "warehouse")
    tables.recreate_tables(spark, root, ["fact_trip"])
    source = landed(spark, sf_dir)
    for folder_year, chosen in ((2023, None), (2024, [3]), (2024, None)):
        loading.load_facts(spark, source, root, YEAR, folder_year, months=chosen)
    loaded = tables.read_table(spark, root, "fact_trip")
    # One row per identity first, so that one given twice would show as too few.
    per_identity = loaded.groupBy("trip_id").agg(
        F.first("pu_date_key").alias("pu_date_key"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
    )
    return flat(
        per_identity.groupBy("pu_date_key").agg(
            F.sum("trips").alias("trips"), F.count(F.lit(1)).alias("identities"), F.sum("revenue").alias("revenue")
        )
    )


@query
def arrivals_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files loaded as they arrive; the second run finds nothing new."""
    source, work = scratch_path(spark, "landed"), scratch_path(spark, "arrivals")
    trips = landing.uniform(monthly(raw_trips(spark, sf_dir)).drop("event_id"), "year", "month")
    months.append_month(trips, source)
    for _ in range(2):
        loading_run = arrivals.load_arrivals(
            arrivals.arriving_trips(spark, source), f"{work}/fact", f"{work}/checkpoint", YEAR
        )
        loading_run.awaitTermination()
    loaded = spark.read.parquet(f"{work}/fact")
    return flat(
        loaded.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue"))
    )


# ---- model


def error_per_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = F.col("fare_amount") + 3 * F.col("vendor_id").cast("decimal(5,0)")
    return (
        facts(spark, sf_dir)
        .groupBy("vendor_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            metrics.rmse(F.col("total_amount"), predicted).alias("rmse"),
        )
    )


@query
def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(error_per_vendor(spark, sf_dir).withColumn("rmse", F.round("rmse", 4)))


@query
def model_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = error_per_vendor(spark, sf_dir)
    saved = metrics.passes_gate(F.col("rmse")).alias("saved")
    return flat(errors.select("vendor_id", F.round("rmse", 4).alias("rmse"), saved))


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn, test = forest.split(table(spark, sf_dir, "events").select("event_id"), "event_id")
    return learn.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@query
def snapshot_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the landed trips, one of them by way of more files: their rows have the same
    keys, and so fall on the same sides."""
    sides = []
    for name in ("one", "two"):
        out = scratch_path(spark, f"snapshot_{name}")
        training.snapshot(spark, landed(spark, sf_dir), out, 2024, range(1, 13))
        rows = training.read_snapshot(spark, out)
        rows = rows.repartition(7) if name == "two" else rows
        learn, test = forest.split(rows, "row_key")
        sides.append(learn.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))))
    one, two = (side.select("row_key", F.col("is_test").alias(f"test_{n}")) for n, side in enumerate(sides))
    both = one.join(two, "row_key", "full")
    moved = F.sum((~F.col("test_0").eqNullSafe(F.col("test_1"))).cast("int"))
    return flat(
        both.agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("row_key").alias("keys"),
            moved.alias("moved"),
            F.avg(F.col("test_0").cast("int")).between(0.1, 0.3).alias("about_a_fifth"),
        )
    )


def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training columns, stored: fitting reads them many times."""

    def write(path: str) -> None:
        snapshots.write_parquet(columns.training_columns(raw_trips(spark, sf_dir), "event_id"), path)

    return spark.read.parquet(stored(spark, sf_dir, "training", write))


# The queries' tables are small: so few parts serve them.
FIT_PARTITIONS = 4
_TRAINED: dict[tuple[str, str], training.Fitted] = {}


def trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, training.Fitted, str]:
    """The stored frame, the model of all trees and levels fitted to it by this or an earlier application, and its folder."""
    frame = training_frame(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        rows = frame.count()
        memory_mb = fitting_memory(spark, rows, min(forest.TREES, forest.at_once(rows)))
        store, name = shared_path(spark, "models"), re.sub(r"\W+", "_", sf_dir)
        _TRAINED[key] = training.train_once(
            frame, "event_id", store, name, memory_mb=memory_mb, partitions=FIT_PARTITIONS
        )
    return frame, _TRAINED[key], _TRAINED[key].path


def label_range(frame: DataFrame) -> DataFrame:
    """The least and the largest label, as one row."""
    return frame.agg(F.min(schema.LABEL).alias("_low"), F.max(schema.LABEL).alias("_high"))


def in_range(predicted: DataFrame, frame: DataFrame) -> DataFrame:
    """Whether predictions lie within the labels, as averages of labels must, give or take rounding."""
    low, high = label_range(frame).first()
    return predicted.withColumn("in_range", F.col("prediction").between(low - 1e-6, high + 1e-6)).drop("prediction")


@query
def rf_train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, result, _ = trained(spark, sf_dir)
    spread = F.stddev_pop(schema.LABEL)
    return flat(
        frame.agg(
            F.count(F.lit(1)).alias("trips"),
            F.count(schema.LABEL).alias("labelled"),
            F.round(spread, 4).alias("label_spread"),
            (F.lit(result.rmse) < spread / 2).alias("better_than_half_the_spread"),
            F.lit(result.saved == (result.rmse < metrics.MAX_RMSE)).alias("saved_if_good"),
            F.lit(forest.tree_count(result.model)).alias("trees"),
        )
    )


@query
def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, result, _ = trained(spark, sf_dir)
    _, test = forest.split(columns.features_and_label(frame, "event_id"), "event_id")
    return in_range(result.model.transform(test).select("event_id", "label", "prediction"), frame)


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the model and of a copy saved and loaded, compared by the number of passengers."""
    frame, result, _ = trained(spark, sf_dir)
    _, test = forest.split(columns.features_and_label(frame, "event_id"), "event_id")
    path = scratch_path(spark, "model_copy")
    forest.save(result.model, path)
    reloaded = forest.load(path)
    own = result.model.transform(test).select("event_id", *schema.FEATURES, F.col("prediction").alias("own"))
    both = forest.score(reloaded, own, "event_id", "own", "passenger_count")
    return flat(
        both.groupBy("passenger_count").agg(
            F.count(F.lit(1)).alias("trips"),
            F.countDistinct("event_id").alias("events"),
            F.sum((F.col("own") != F.col("prediction")).cast("int")).alias("differing"),
        ),
        "passenger_count",
    )


@query
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _, path = trained(spark, sf_dir)
    return in_range(training.score_table(path, frame, "event_id").fillna("", ["input_problem"]), frame)


@query
def score_input_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.tag(raw_trips(spark, sf_dir), rules.model_input_rules(), "input_problem")
    return judged.select("event_id", F.coalesce("input_problem", F.lit("")).alias("input_problem"))


# ---- implied by the star schema


@query
def star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = star.star_view(facts(spark, sf_dir), all_dimensions(spark, sf_dir))
    shown = view.select(
        "event_id",
        "vendor_name",
        "ratecode_label",
        "payment_type_label",
        "store_and_fwd_label",
        "pu_borough",
        "pu_zone_name",
        "do_zone_name",
        "do_service_zone",
        "pu_full_date",
        "do_day_of_week",
        "pu_full_time",
        "do_full_time",
        "total_amount",
    )
    return flat(shown, "do_day_of_week")


@query
def weekday_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(star.weekday_revenue(facts(spark, sf_dir), dimensions.year_calendar(spark, YEAR)))
