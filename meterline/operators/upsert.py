"""Insert-or-ignore."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by `order_by`, missing orders last; equal orders are settled by a
    hash of the row, and rows alike throughout are one.

    Aggregates rather than a ranking window: every task reduces its rows to one per key
    before the shuffle, so a key with a third of the rows costs one row per task. Each order
    column in turn is reduced to its least value, and the rows that have it go on. Values of
    fixed width are reduced in a hash table; text has to be sorted.
    """
    for name in order_by:
        df = _with_least(df, key, F.col(name))
    # Rows that are left differ in no order column.
    return _with_least(df, key, F.xxhash64(*df.columns)).distinct()


def _with_least(df: DataFrame, key: Sequence[str], order: Column) -> DataFrame:
    least = df.groupBy(*[F.col(name).alias(f"_of_{name}") for name in key]).agg(F.min(order).alias("_least"))
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in key]
    return df.join(least, reduce(and_, [*same, order.eqNullSafe(F.col("_least"))]), "left_semi")


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """The rows of `batch` to append to `target`: the first of each key that it lacks.

    Keys are compared null-safe, so that a second run adds nothing even for a missing key
    (which the NOT NULL audit reports).
    """
    first = first_per_key(batch, key, order_by).select(*target.columns)
    held = target.select(*[F.col(name).alias(f"_held_{name}") for name in key])
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_held_{name}")) for name in key])
    return first.join(held, same, "left_anti")


def insert_or_ignore(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
) -> DataFrame:
    """`target` with the new rows of `batch`; rows already there win."""
    return target.unionByName(new_rows(target, batch, key, order_by))
