"""Column-level steps: optional columns, the model's columns, features and label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline import schema


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each column that `df` lacks, with its default (a literal or a Column).

    Names are compared without case, as Spark resolves them: a file that spells
    `Airport_fee` has the column, so its values are kept and only the name is changed.
    """
    present = {name.lower(): name for name in df.columns}
    renamed, added = {}, {}
    for name, default in defaults.items():
        found = present.get(name.lower())
        if found is None:
            added[name] = default if isinstance(default, Column) else F.lit(default)
        elif found != name:
            renamed[found] = name
    return df.withColumnsRenamed(renamed).withColumns(added)


def complete_raw(df: DataFrame) -> DataFrame:
    """Raw trips with the two optional fee columns present."""
    return ensure_columns(df, schema.OPTIONAL_RAW_COLUMNS)


def model_columns(df: DataFrame, *keep: str) -> DataFrame:
    """`keep` and the ten columns cut from raw trips for the model."""
    return df.select(*keep, *schema.MODEL_COLUMNS)


def training_columns(df: DataFrame, *keep: str) -> DataFrame:
    """`keep`, features and label: the model columns without the two datetimes."""
    return model_columns(df, *keep).drop(schema.PICKUP, schema.DROPOFF)


def features_and_label(df: DataFrame, *keep: str) -> DataFrame:
    """`keep`, the seven features in model order, and the label, all as doubles."""
    features = [f"CAST({name} AS DOUBLE) AS {name}" for name in schema.FEATURES]
    return df.selectExpr(*keep, *features, f"CAST({schema.LABEL} AS DOUBLE) AS label")
