"""The same answers however the rows are spread, and with a third of them under one key."""

import pytest
from pyspark.sql import functions as F

from meterline.operators import audits, dimensions, forest, numbering, rules, upsert
from meterline.plans.catalog import facts, raw_trips

SF_DIR = "/root/testdata/sf0.001"


def hot(spark, rows=30_000):
    """Keys of which one holds a third of the rows."""
    return spark.range(rows).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1L ELSE id END AS k", "id * 7 % 1000 AS v")


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_layout_changes_nothing(spark, parts):
    trips = raw_trips(spark, SF_DIR)
    spread = trips.repartition(parts)
    table = rules.trip_rules(2024)

    def reasons(df):
        return sorted((r["event_id"], r["reject_reason"]) for r in rules.reject(df, table).collect())

    def tested(df):
        return sorted(r["event_id"] for r in forest.split(df, "event_id")[1].collect())

    def ids(df):
        return sorted((r["event_id"], r["trip_id"]) for r in numbering.assign_ids(df, ["event_id"]).collect())

    trips, spread = (df.withColumnRenamed("Airport_fee", "airport_fee") for df in (trips, spread))
    assert reasons(trips) == reasons(spread)
    assert tested(trips) == tested(spread)
    assert ids(trips.select("event_id")) == ids(spread.select("event_id"))


def test_ids_go_on_from_the_last_without_gaps(spark):
    numbered = numbering.assign_ids(hot(spark), ["k", "id"], start=101, partitions=16)
    assert numbered.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first() == (101, 30_100, 30_000)
    first = numbered.orderBy("trip_id").first()
    assert (first["k"], first["id"]) == (-1, 0)
    assert numbering.next_id(numbered) == 30_101
    again = {r["id"]: r["trip_id"] for r in numbered.collect()}
    assert again == {r["id"]: r["trip_id"] for r in numbered.collect()}


def test_the_hot_key_is_split_between_ranges(spark):
    numbered = numbering.assign_ids(hot(spark), ["k", "id"], partitions=16)
    files = numbered.filter("k = -1").select(F.input_file_name()).distinct().count()
    assert files > 3


def test_unordered_ids_are_dense_and_unique_even_for_copies(spark):
    copies = spark.range(10_000).selectExpr("1 AS same").repartition(5)
    numbered = numbering.assign_ids(copies)
    assert numbered.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first() == (1, 10_000, 10_000)
    assert numbering.assign_ids(copies.filter("false")).count() == 0
    assert numbering.next_id(numbering.assign_ids(copies.filter("false"))) == 1


def test_hot_key_answers(spark):
    df = hot(spark)
    found = audits.duplicate_keys(df, ["k"], "t").collect()
    assert [(r["key_value"], r["row_count"]) for r in found] == [("-1", 10_000)]
    first = upsert.first_per_key(df, ["k"], ["v", "id"])
    assert first.count() == 20_001
    assert first.filter("k = -1").first()["id"] == 0


def test_split_share(spark):
    learn, test = forest.split(spark.range(50_000), "id")
    assert learn.count() + test.count() == 50_000
    assert abs(test.count() / 50_000 - 0.2) < 0.01


def test_orphans_equal_one_anti_join_per_key(spark):
    trips = facts(spark, SF_DIR)
    zones = spark.range(1, 200).selectExpr("CAST(id AS INT) AS location_id", "'b' AS borough")
    known = dimensions.seed_dimensions(spark, zones, 2024)
    together = {(r["foreign_key"], r["key_value"]): r["row_count"] for r in audits.orphans(trips, known).collect()}
    apart = {}
    for column, (table, key) in audits.schema.FOREIGN_KEYS.items():
        lost = trips.join(known[table], trips[column] == known[table][key], "left_anti").groupBy(column).count()
        apart |= {(column, str(row[0])): row[1] for row in lost.collect()}
    assert together == apart and len(apart) > 10
