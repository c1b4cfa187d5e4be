"""One hand-made row per edge."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from meterline import schema
from meterline.operators import audits, dimensions, fact, rules

YEAR = 2024


def verdicts(df):
    tagged = rules.tag(df, rules.trip_rules(YEAR))
    return [row["reject_reason"] for row in tagged.collect()]


def facts(df):
    return fact.fact_rows(df, YEAR).collect()


def test_dropoff_may_equal_but_not_precede_pickup(raw):
    at = dt.datetime(2024, 3, 5, 1, 2, 3)
    same, earlier = {"tpep_dropoff_datetime": at}, {"tpep_dropoff_datetime": at - dt.timedelta(seconds=1)}
    assert verdicts(raw(same, earlier)) == [None, "dropoff_not_before_pickup"]


def test_only_the_pickup_has_to_lie_in_the_year(raw):
    first, after = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)
    trips = raw(
        {"tpep_pickup_datetime": first},
        {"tpep_pickup_datetime": after, "tpep_dropoff_datetime": after},
        {"tpep_pickup_datetime": first - dt.timedelta(microseconds=1)},
        {"tpep_pickup_datetime": after - dt.timedelta(seconds=1), "tpep_dropoff_datetime": after},
    )
    assert verdicts(trips) == [None, "pickup_in_year", "pickup_in_year", None]


def test_codes_must_be_present(raw):
    names = ["VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID"]
    assert verdicts(raw(*[{name: None} for name in names])) == [f"{name}_present" for name in names]


def test_measures_may_be_missing_but_not_negative(raw):
    below = [{name: -1 if name == "passenger_count" else -0.01} for name in schema.MEASURE_COLUMNS]
    assert verdicts(raw(*below)) == [f"{name}_not_negative" for name in schema.MEASURE_COLUMNS]
    missing = raw(*[{name: None} for name in schema.MEASURE_COLUMNS])
    assert verdicts(missing) == [None] * len(schema.MEASURE_COLUMNS)
    assert [row[name] for row, name in zip(facts(missing), schema.MEASURE_COLUMNS, strict=True)] == [0] * 12


def test_amounts_that_do_not_fit_are_turned_away(raw):
    trips = raw(*[{"fare_amount": value} for value in (float("nan"), float("inf"), 1e9, 99999999.995)])
    assert verdicts(trips) == ["fare_amount_fits"] * 4


def test_largest_amount_that_fits_is_kept(raw):
    (kept,) = facts(raw({"fare_amount": 99999999.994, "trip_distance": 9999999.999}))
    assert (kept["fare_amount"], kept["trip_distance"]) == (Decimal("99999999.99"), Decimal("9999999.999"))


def test_codes_that_do_not_fit_are_turned_away(raw):
    assert verdicts(raw({"VendorID": 70000}, {"VendorID": 32767})) == ["VendorID_fits", None]


def test_fractions_of_passengers_are_judged_before_they_are_cut(raw):
    counts = F.expr("CASE passenger_count WHEN 1 THEN -0.5D WHEN 2 THEN 1.5D ELSE double('NaN') END")
    trips = raw({"passenger_count": 1}, {"passenger_count": 2}, {"passenger_count": 3})
    trips = trips.withColumn("passenger_count", counts)
    assert verdicts(trips) == ["passenger_count_not_negative", None, "passenger_count_fits"]
    assert [row["passenger_count"] for row in facts(trips)] == [1]


def test_the_first_failing_rule_is_named(raw):
    assert verdicts(raw({"VendorID": None, "fare_amount": -1.0, "tpep_pickup_datetime": None})) == ["pickup_present"]


def test_ties_are_rounded_half_up_on_the_printed_digits(raw):
    (kept,) = facts(raw({"fare_amount": 1.005}))
    assert kept["fare_amount"] == Decimal("1.01")


def test_flag(raw):
    kept = facts(raw(*[{"store_and_fwd_flag": flag} for flag in (None, "Yes", "")]))
    assert [row["store_and_fwd_flag"] for row in kept] == ["N", "Y", ""]


def test_keys_and_types(raw):
    df = fact.fact_rows(raw({}), YEAR)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in schema.FACT_TRIP if f.name != "trip_id"
    ]
    row = df.first()
    assert (row["pu_date_key"], row["pu_time_key"], row["do_time_key"]) == (20240305, 10203, 11203)


def test_a_fee_under_another_spelling_is_kept(raw):
    trips = raw({"airport_fee": 1.75}).withColumnRenamed("airport_fee", "Airport_fee")
    (kept,) = facts(trips)
    assert kept["airport_fee"] == Decimal("1.75")


def test_absent_fees_are_zero(raw):
    (kept,) = facts(raw({}).drop("airport_fee", "cbd_congestion_fee"))
    assert (kept["airport_fee"], kept["cbd_congestion_fee"]) == (0, 0)


def test_accepted_and_rejected_share_the_rows_and_accepted_ones_break_no_check(spark):
    from meterline.plans.catalog import raw_trips
    from meterline.operators.columns import complete_raw

    trips = complete_raw(raw_trips(spark, "/root/testdata/sf0.001"))
    table = rules.trip_rules(YEAR)
    assert rules.accept(trips, table).count() + rules.reject(trips, table).count() == trips.count()
    kept = fact.conform(rules.accept(trips, table))
    checks = audits.fact_checks()[1:]  # an empty flag is accepted, and reported by the audit
    assert rules.violating(kept, checks).count() == 0
    assert rules.violating(kept, audits.fact_checks()).count() == kept.filter("store_and_fwd_flag = ''").count() > 0
    missing = audits.missing_values(kept, schema.FACT_COLUMNS, "fact_trip")
    assert missing.agg(F.sum("missing")).first()[0] == 0


def test_checks_pass_on_a_missing_answer_and_name_all_they_find(spark):
    rows = spark.createDataFrame([(13, 0, 8), (None, None, None), (12, 31, 7)], "month int, day int, day_of_week int")
    found = rules.violating(rows, audits.calendar_checks()).collect()
    assert [row["violated"] for row in found] == [["month_in_range", "day_in_range", "day_of_week_in_range"]]


def test_orphans_are_reported_and_missing_keys_are_not(spark, raw):
    year_end = dt.datetime(2024, 12, 31, 23, 59, 59)
    trips = raw(
        {"VendorID": 5},
        {"VendorID": 5},
        {"store_and_fwd_flag": ""},
        {"tpep_pickup_datetime": year_end, "tpep_dropoff_datetime": dt.datetime(2025, 1, 1)},
        {"tpep_pickup_datetime": year_end, "tpep_dropoff_datetime": dt.datetime(2025, 1, 2)},
    )
    zones = spark.createDataFrame([(i, None, None, None) for i in range(1, 266)], schema.DIM_ZONE)
    known = dimensions.seed_dimensions(spark, zones, YEAR)
    found = audits.orphans(fact.fact_rows(trips, YEAR), known).collect()
    assert sorted(tuple(row) for row in found) == [
        ("do_date_key", "20250102", 1),
        ("store_and_fwd_flag", "", 1),
        ("vendor_id", "5", 2),
    ]
    unjudged = fact.conform(raw({"VendorID": None}))
    assert audits.orphans(unjudged, known).count() == 0


def test_model_inputs(raw):
    trips = raw(
        {},
        {"passenger_count": 0},
        {"PULocationID": 301},
        {"fare_amount": 50.01},
        {"fare_amount": -50.0},
        {"trip_distance": None},
    )
    tagged = rules.tag(trips, rules.model_input_rules()).collect()
    assert [row["reject_reason"] for row in tagged] == [
        None,
        "passenger_count_in_range",
        "PULocationID_in_range",
        "fare_amount_in_range",
        None,
        "trip_distance_in_range",
    ]
