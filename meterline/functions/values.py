"""Value checks and conversions that never raise and never wrap."""

from __future__ import annotations

from pyspark.sql import types as T

# The ranges of the whole-number types.
_WHOLE_RANGES = {
    "smallint": (-(2**15), 2**15 - 1),
    "int": (-(2**31), 2**31 - 1),
}


def non_negative(value: str) -> str:
    """Missing or at least zero; written as an OR so that Parquet can skip by it."""
    return f"({value} IS NULL OR {value} >= 0)"


def in_range(value: str, kind: str) -> str:
    """Missing or inside the range of a whole-number type once cut. NaN and infinities are outside."""
    return f"({value} IS NULL OR {_inside(value, kind)})"


def not_too_large(value: str, kind: str | T.DecimalType) -> str:
    """Missing or below the first number that `kind` cannot hold once rounded; not so NaN and infinity."""
    if isinstance(kind, T.DecimalType):
        # Half up: from half of the last place below the first number with a digit more.
        first_too_large = f"{10.0 ** (kind.precision - kind.scale) - 0.5 * 10.0**-kind.scale!r}D"
    else:
        first_too_large = str(_WHOLE_RANGES[kind][1] + 1)
    return f"({value} IS NULL OR {value} < {first_too_large})"


def narrow(value: str, kind: str) -> str:
    """Cast a number to a smaller whole-number type; NULL where it does not fit.

    The range is tested first: a TRY_CAST raises and catches an exception per row that does
    not fit, ten times the cost of the row.
    """
    return f"CASE WHEN {_inside(value, kind)} THEN CAST({value} AS {kind}) END"


def _inside(value: str, kind: str) -> str:
    low, high = _WHOLE_RANGES[kind]
    return f"({value} > {low - 1} AND {value} < {high + 1})"


def to_amount(value: str, kind: T.DecimalType) -> str:
    """Cast to a decimal, half up on the printed digits; missing counts as zero."""
    return f"TRY_CAST(coalesce({value}, 0.0D) AS {kind.simpleString()})"


def flag_letter(flag: str) -> str:
    """First character, with N for a missing flag. Empty text stays empty."""
    return f"substring(coalesce(CAST({flag} AS STRING), 'N'), 1, 1)"
