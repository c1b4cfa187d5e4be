"""The zone lookup file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline import schema


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zones from CSV: a header line, commas, double quotes doubled inside text.

    Columns go by position, as the header's names differ from the table's. `N/A` is text;
    only an unquoted empty value is missing. A line that does not fit ends the read.
    """
    return spark.read.csv(
        path,
        schema=schema.DIM_ZONE,
        header=True,
        enforceSchema=True,
        sep=",",
        quote='"',
        escape='"',
        # Not the default "", which would make quoted empty text missing as well.
        nullValue="\0",
        mode="FAILFAST",
    )
