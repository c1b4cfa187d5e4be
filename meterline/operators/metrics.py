"""Model error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the error a model must stay under to be saved.
MAX_RMSE = 10.0


def rmse(actual: Column, predicted: Column) -> Column:
    """Root mean squared error, an aggregate; use it in `agg` with or without groups."""
    error = actual - predicted
    return F.sqrt(F.avg(error * error))


def passes_gate(error: Column, threshold: float = MAX_RMSE) -> Column:
    """True where a model's error is strictly under the threshold; a missing error fails."""
    return F.coalesce(error < threshold, F.lit(False)) & ~F.isnan(error.cast("double"))
