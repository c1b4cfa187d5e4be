"""Scalar functions, as Spark SQL expression text made of built-in functions.

Each takes and returns text, for `selectExpr`, `expr` and the rule tables: an argument is a
column name or any other expression.
"""

from meterline.functions.temporal import (
    date_key,
    day_of_week,
    hhmmss_interval,
    hhmmss_seconds,
    hour_of,
    is_weekend,
    minute_of,
    second_of,
    seconds_to_key,
    seconds_to_text,
    time_key,
    within_year,
)
from meterline.functions.values import (
    flag_letter,
    in_range,
    narrow,
    non_negative,
    not_too_large,
    to_amount,
)

__all__ = [
    "date_key",
    "day_of_week",
    "flag_letter",
    "hhmmss_interval",
    "hhmmss_seconds",
    "hour_of",
    "in_range",
    "is_weekend",
    "minute_of",
    "narrow",
    "non_negative",
    "not_too_large",
    "second_of",
    "seconds_to_key",
    "seconds_to_text",
    "time_key",
    "to_amount",
    "within_year",
]
