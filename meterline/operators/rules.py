"""Named row rules: which rows to keep, which to turn away and why, and how often each rule fails.

A rule table is an ordered list of `Rule`, its predicates being SQL text over the columns.
A row passes a rule only where its predicate is true, so a missing answer fails. Every
operator here is one pass over the rows without a shuffle of them; only counts are combined.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline import schema
from meterline.functions import in_range, non_negative, not_too_large, within_year


class Rule(NamedTuple):
    name: str
    passes: str


def trip_rules(year: int) -> list[Rule]:
    """The accept rules for raw trips picked up in `year`, in order.

    The first 21 are the warehouse's load rules. The `_fits` rules that follow turn away
    values the fact table cannot hold (NaN, infinities, out of range) instead of letting
    them become NULL, wrap or end the job.
    """
    rules = [
        Rule("pickup_present", f"{schema.PICKUP} IS NOT NULL"),
        Rule("dropoff_present", f"{schema.DROPOFF} IS NOT NULL"),
        Rule("dropoff_not_before_pickup", f"{schema.DROPOFF} >= {schema.PICKUP}"),
    ]
    for name in ("VendorID", "RatecodeID", "payment_type", "PULocationID", "DOLocationID"):
        rules.append(Rule(f"{name}_present", f"{name} IS NOT NULL"))
    rules.append(Rule("pickup_in_year", within_year(schema.PICKUP, year)))
    for name in schema.MEASURE_COLUMNS:
        rules.append(Rule(f"{name}_not_negative", non_negative(name)))
    for name in ("VendorID", "RatecodeID", "payment_type"):
        rules.append(Rule(f"{name}_fits", in_range(name, "smallint")))
    for name in ("PULocationID", "DOLocationID"):
        rules.append(Rule(f"{name}_fits", in_range(name, "int")))
    # Measures are not negative by now, so only their upper end is left to check.
    rules.append(Rule("passenger_count_fits", not_too_large("passenger_count", "smallint")))
    rules.append(Rule("trip_distance_fits", not_too_large("trip_distance", schema.DISTANCE)))
    for name in schema.MONEY_COLUMNS:
        rules.append(Rule(f"{name}_fits", not_too_large(name, schema.MONEY)))
    return rules


# The closed ranges a model input is accepted in.
MODEL_INPUT_RANGES = {
    "PULocationID": (1, 300),
    "DOLocationID": (1, 300),
    "passenger_count": (1, 4),
    "fare_amount": (-50, 50),
    "extra": (0, 15),
    "tip_amount": (0, 15),
    "trip_distance": (0, 500),
}


def model_input_rules() -> list[Rule]:
    return [
        Rule(f"{name}_in_range", f"{name} BETWEEN {low} AND {high}")
        for name, (low, high) in MODEL_INPUT_RANGES.items()
    ]


def accept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule."""
    return df.filter(" AND ".join(f"({rule.passes})" for rule in rules))


def tag(df: DataFrame, rules: Sequence[Rule], into: str = "reject_reason") -> DataFrame:
    """All rows, with the first rule each fails; NULL for rows that pass them all."""
    return df.withColumn(into, F.expr(_first_failure(rules)))


def reject(df: DataFrame, rules: Sequence[Rule], into: str = "reject_reason") -> DataFrame:
    """Rows that fail some rule, with the first they fail.

    The verdict goes through a one-element explode, since Spark does not move a filter past
    it. A filter on a plain column would be moved and go through the rules a second time, in
    a method too long for the JVM to compile: measured, twenty times slower.
    """
    verdict = F.explode(F.expr(f"array({_first_failure(rules)})"))
    return df.select("*", verdict.alias(into)).filter(f"{into} IS NOT NULL")


def count_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, failed): rows that fail each rule, whatever else they fail; in rule order."""
    return count_each(df, {rule.name: _fails(rule) for rule in rules}, "rule", "failed")


def count_violations(df: DataFrame, checks: Sequence[Rule], table: str) -> DataFrame:
    """(table_name, check_name, violations) as SQL CHECKs count: a missing answer passes."""
    counted = count_each(df, {check.name: f"NOT ({check.passes})" for check in checks}, "check_name", "violations")
    return counted.selectExpr(f"'{table}' AS table_name", "*")


def violating(df: DataFrame, checks: Sequence[Rule], into: str = "violated") -> DataFrame:
    """Rows that break a check, with the names of all they break."""
    names = ", ".join(f"CASE WHEN NOT ({check.passes}) THEN '{check.name}' END" for check in checks)
    return df.withColumn(into, F.expr(f"array_compact(array({names}))")).filter(f"size({into}) > 0")


def count_each(df: DataFrame, conditions: dict[str, str], key: str, value: str) -> DataFrame:
    """(key, value): for each named condition, the rows where it is true; one pass for them all."""
    counts = [F.expr(f"count(CASE WHEN {condition} THEN 1 END) AS {name}") for name, condition in conditions.items()]
    pairs = ", ".join(f"'{name}', {name}" for name in conditions)
    return df.agg(*counts).selectExpr(f"stack({len(conditions)}, {pairs}) AS ({key}, {value})")


def _first_failure(rules: Sequence[Rule]) -> str:
    return " ".join(["CASE", *[f"WHEN {_fails(rule)} THEN '{rule.name}'" for rule in rules], "END"])


def _fails(rule: Rule) -> str:
    return f"NOT coalesce({rule.passes}, false)"
