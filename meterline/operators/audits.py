"""The warehouse's declared constraints as queries: Parquet enforces none of them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.operators.rules import Rule, count_each


# Rows that one task counts by key. Keys in a row compress to almost nothing, so partitions are cut
# by rows: by bytes, millions of them would pass for a small one.
KEY_ROWS = 1 << 20


def duplicate_keys(df: DataFrame, key: Sequence[str], table: str, constraint: str = "primary_key") -> DataFrame:
    """(table_name, constraint_name, key_value, row_count) of keys that repeat or are missing.

    Only the key columns are read, after the rows are counted. Counts are combined per batch
    before the shuffle, so a key held by a third of the rows arrives as one partial count per
    batch, and no task holds more keys than a batch before it and about `KEY_ROWS` after it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            yield from rows.group_by(rows.column_names).aggregate([([], "count_all")]).to_batches()

    keys = df.select(*key)
    parts = keys.count() // KEY_ROWS + 1
    combined = keys.mapInArrow(run, T.StructType([*keys.schema, T.StructField("row_count", T.LongType())]))
    counted = combined.repartition(parts, *key).groupBy(*key).agg(F.sum("row_count").alias("row_count"))
    missing = " OR ".join(f"{name} IS NULL" for name in key)
    text = ", ".join(f"coalesce(CAST({name} AS STRING), 'NULL')" for name in key)
    return counted.filter(f"row_count > 1 OR {missing}").selectExpr(
        f"'{table}' AS table_name",
        f"'{constraint}' AS constraint_name",
        f"concat_ws('|', {text}) AS key_value",
        "row_count",
    )


def table_key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`duplicate_keys` for the primary keys and unique columns of the given warehouse tables."""
    found = []
    for name, df in tables.items():
        found.append(duplicate_keys(df, [schema.PRIMARY_KEYS[name]], name))
        if name in schema.UNIQUE_COLUMNS:
            found.append(duplicate_keys(df, [schema.UNIQUE_COLUMNS[name]], name, "unique"))
    return reduce(DataFrame.unionByName, found)


def missing_values(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """(table_name, column_name, missing): NULLs per column, in one pass over all of them."""
    counted = count_each(df, {name: f"{name} IS NULL" for name in columns}, "column_name", "missing")
    return counted.selectExpr(f"'{table}' AS table_name", "*")


def required_columns(table: T.StructType) -> list[str]:
    return [field.name for field in table if not field.nullable]


def fact_checks() -> list[Rule]:
    """CHECKs of the fact table, and the flag's, which its dimension declares."""
    checks = flag_checks()
    checks += [Rule(f"{name}_not_negative", f"{name} >= 0") for name in schema.MEASURE_COLUMNS]
    checks.append(Rule("dropoff_not_before_pickup", "dropoff_datetime >= pickup_datetime"))
    return checks


def flag_checks() -> list[Rule]:
    """The CHECK that the flag's own dimension declares."""
    return [Rule("flag_is_y_or_n", "store_and_fwd_flag IN ('Y', 'N')")]


def table_checks() -> dict[str, list[Rule]]:
    """All declared CHECKs by table."""
    return {
        "fact_trip": fact_checks(),
        "dim_store_and_fwd": flag_checks(),
        "dim_date": calendar_checks(),
        "dim_time": time_checks(),
    }


def calendar_checks() -> list[Rule]:
    return _ranges({"month": (1, 12), "day": (1, 31), "day_of_week": (1, 7)})


def time_checks() -> list[Rule]:
    return _ranges({"hour": (0, 23), "minute": (0, 59), "second": (0, 59)})


def _ranges(bounds: Mapping[str, tuple[int, int]]) -> list[Rule]:
    return [Rule(f"{name}_in_range", f"{name} BETWEEN {low} AND {high}") for name, (low, high) in bounds.items()]


def orphans(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    foreign_keys: Mapping[str, tuple[str, str]] = schema.FOREIGN_KEYS,
) -> DataFrame:
    """(foreign_key, key_value, row_count) of fact keys that their dimension lacks.

    The fact is read once: its keys are laid under each other as (which key, value), counted
    per value with partial counts before the shuffle, and what is left (one row per distinct
    value) is checked against the dimensions. No dimension is sent to the fact's tasks, and
    a value that a third of the rows share moves as one count per task.
    """
    layout, rows = fact.schema, []
    for place, name in enumerate(foreign_keys):
        # Whole numbers are counted as such, which is cheaper than as text.
        whole = isinstance(layout[name].dataType, T.IntegralType)
        number, text = (f"CAST({name} AS BIGINT)", "NULL") if whole else ("NULL", f"CAST({name} AS STRING)")
        rows.append(f"{place}, CAST({number} AS BIGINT), CAST({text} AS STRING)")
    keys = fact.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (place, number, text)")
    counted = keys.groupBy("place", "number", "text").agg(F.count(F.lit(1)).alias("row_count"))
    names = ", ".join(f"'{name}'" for name in foreign_keys)
    used = counted.selectExpr(
        f"element_at(array({names}), place + 1) AS foreign_key",
        "coalesce(CAST(number AS STRING), text) AS key_value",
        "row_count",
    ).filter("key_value IS NOT NULL")  # a missing key is the NOT NULL audit's finding

    known = [
        dimensions[table].selectExpr(
            f"'{name}' AS foreign_key", f"CAST({key} AS STRING) AS key_value", "true AS known"
        )
        for name, (table, key) in foreign_keys.items()
    ]
    # Not an anti join: Spark would move that below the count, to every key of every row.
    looked_up = used.join(reduce(DataFrame.unionAll, known), ["foreign_key", "key_value"], "left")
    return looked_up.filter("known IS NULL").drop("known")
