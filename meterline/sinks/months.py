"""The landed tree: Parquet under year=/month=."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def append_month(df: DataFrame, root: str, period: tuple[str, str] | None = None) -> None:
    """Add rows to the month folder of `period`, or else of their `year` and `month` columns.

    A second run with the same rows holds them twice.
    """
    _by_month(df, period).mode("append").parquet(root)


def replace_month(df: DataFrame, root: str, period: tuple[str, str] | None = None) -> None:
    """Put rows in place of what their months hold, leaving other months alone: safe to repeat."""
    _by_month(df, period).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def _by_month(df: DataFrame, period: tuple[str, str] | None) -> DataFrameWriter:
    # Tasks write straight into the folders of the rows they hold: no shuffle, and a month
    # with most of the rows is written by all tasks.
    if period:
        df = df.withColumns({"year": F.lit(period[0]), "month": F.lit(period[1])})
    return df.write.partitionBy("year", "month")
