"""Whole-frame snapshots and the check after a write."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


class WriteReport(NamedTuple):
    rows_given: int
    rows_written: int
    same_schema: bool
    same_content: bool

    @property
    def good(self) -> bool:
        return self.rows_given == self.rows_written and self.same_schema and self.same_content


def write_verified(df: DataFrame, path: str) -> WriteReport:
    """Write Parquet, read it back and compare rows, column types and a checksum of all values.

    The source is counted while it is written, so it is computed once.
    """
    given = Observation()
    count = F.count(F.lit(1)).alias("rows")
    df.observe(given, count, checksum(df)).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.parquet(path)
    found = written.agg(count, checksum(written)).first()
    return WriteReport(
        given.get["rows"],
        found["rows"],
        _types(df.schema) == _types(written.schema),
        given.get["checksum"] == found["checksum"],
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows, as a look at what was written."""
    return df.limit(rows)


def checksum(df: DataFrame):
    """An aggregate over all values of all rows, whatever their order."""
    # A sum does not depend on row order; 38 digits hold it for any number of rows.
    return F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("checksum")


def _types(layout: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(field.name, field.dataType) for field in layout]
