"""What Spark does with the queries: pushed filters, pruned columns and folders, no needless shuffle."""

import re

import pytest

from meterline import schema
from meterline.operators import columns, fact, rules
from meterline.plans.catalog import QUERIES
from meterline.sinks.months import append_month
from meterline.sources.trips import read_months, read_year

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def landed(spark, raw, tmp_path):
    for month in ("01", "02", "03"):
        append_month(raw({}, {}), str(tmp_path), ("2024", month))
    append_month(raw({}), str(tmp_path), ("2023", "01"))
    return str(tmp_path)


def test_rules_reach_the_scan_and_nothing_is_shuffled(spark, landed):
    df = fact.fact_rows(read_year(spark, landed, 2024), 2024)
    text = scan_of(df)
    pushed = re.search(r"PushedFilters: \[(.*)", text)[1]
    assert "IsNotNull(VendorID)" in pushed
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in pushed
    assert "LessThan(tpep_pickup_datetime,2025-01-01T00:00)" in pushed
    assert "Or(IsNull(fare_amount),GreaterThanOrEqual(fare_amount,0.0))" in pushed
    assert "Exchange" not in text and "Python" not in text
    assert len(re.findall(r"Scan parquet", text)) == 2  # once in the tree, once in its details


def test_the_whole_judgement_is_one_compiled_stage_small_enough_for_the_jit(spark, landed):
    df = fact.fact_rows(read_year(spark, landed, 2024), 2024)
    trips, table = columns.complete_raw(read_year(spark, landed, 2024)), rules.trip_rules(2024)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    for judged in (df, rules.tag(trips, table), rules.reject(trips, table)):
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", judged._jdf.queryExecution().explainString(mode))
        # The JVM does not compile methods beyond 8000 bytes.
        assert len(sizes) == 1 and int(sizes[0]) < 8000


def test_only_the_chosen_folders_and_columns_are_read(spark, landed):
    df = columns.training_columns(read_months(spark, landed, 2024, [1, 3]))
    assert len(df.inputFiles()) <= 4 and all("month=02" not in f and "year=2024" in f for f in df.inputFiles())
    read = re.search(r"ReadSchema: struct<(.*?)>", scan_of(df))[1]
    assert {part.split(":")[0] for part in read.split(",")} == {*schema.FEATURES, schema.LABEL}


@pytest.mark.parametrize("name", ["reject_counts", "not_null_audit", "check_audit"])
def test_counts_read_rows_once_and_shuffle_only_counts(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "SinglePartition" in text and "partial_count" in text
    assert "hashpartitioning" not in text and "Window" not in text


def test_orphans_read_the_facts_once_without_sending_dimensions_to_them(spark):
    text = plan(QUERIES["fk_audit"](spark, SF_DIR))
    assert text.count("FileScan parquet") == 1
    counted = text.index("partial_count")
    assert text.index("Join") < counted and "Join" not in text[counted:]


def test_star_joins_without_shuffling_the_facts(spark):
    text = plan(QUERIES["star_view"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 10
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_insert_or_ignore_sorts_no_batch(spark):
    text = plan(QUERIES["insert_or_ignore"](spark, SF_DIR))
    assert "HashAggregate" in text and "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_revenue_is_added_up_before_the_dates_are_joined(spark):
    text = plan(QUERIES["weekday_revenue"](spark, SF_DIR))
    assert text.index("Join") < text.index("partial_sum(total_amount")


FITTING = {"rf_train_metrics", "rf_predict", "model_roundtrip", "batch_score"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTING))
def test_no_query_has_a_cross_join_a_global_window_or_row_wise_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Pandas"):
        assert operator not in text, operator
