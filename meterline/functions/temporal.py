"""Date and time keys. Whole-number arithmetic throughout: formatting a timestamp to text
and parsing the digits back gives the same keys at several times the cost per row."""

from __future__ import annotations


def date_key(moment: str) -> str:
    """yyyymmdd as an int, of a date or a timestamp."""
    return f"(year({moment}) * 10000 + month({moment}) * 100 + day({moment}))"


def time_key(moment: str) -> str:
    """hhmmss as an int; 01:02:03 gives 10203."""
    return f"(hour({moment}) * 10000 + minute({moment}) * 100 + second({moment}))"


def within_year(moment: str, year: int) -> str:
    """True inside the calendar year. Half-open on the bare column, so the scan can skip by it."""
    first, after = (f"TIMESTAMP_NTZ'{start:04d}-01-01 00:00:00'" for start in (year, year + 1))
    return f"({moment} >= {first} AND {moment} < {after})"


def day_of_week(day: str) -> str:
    """1 for Monday to 7 for Sunday."""
    return f"(weekday({day}) + 1)"


def is_weekend(day: str) -> str:
    return f"(weekday({day}) >= 5)"


def hour_of(second_of_day: str) -> str:
    return f"(CAST({second_of_day} AS INT) DIV 3600)"


def minute_of(second_of_day: str) -> str:
    return f"(CAST({second_of_day} AS INT) % 3600 DIV 60)"


def second_of(second_of_day: str) -> str:
    return f"(CAST({second_of_day} AS INT) % 60)"


def seconds_to_key(second_of_day: str) -> str:
    """Second of the day (0 to 86399) as hhmmss."""
    hour, minute, second = (part(second_of_day) for part in (hour_of, minute_of, second_of))
    return f"CAST({hour} * 10000 + {minute} * 100 + {second} AS INT)"


def seconds_to_text(second_of_day: str) -> str:
    """Second of the day as HH:mm:ss text."""
    hour, minute, second = (part(second_of_day) for part in (hour_of, minute_of, second_of))
    return f"format_string('%02d:%02d:%02d', {hour}, {minute}, {second})"


def hhmmss_seconds(packed: str) -> str:
    """Seconds in an hhmmss number, e.g. 123456 gives 45296. Digits are not range-checked; a sign
    takes the place of a digit, so -50 gives 50 and -12345 the seconds of -1, 23 and 45."""
    hour, minute, second = _unpack(packed)
    return f"({hour} * 3600 + {minute} * 60 + {second})"


def hhmmss_interval(packed: str) -> str:
    """The same as a day-time interval."""
    hour, minute, second = _unpack(packed)
    return f"make_dt_interval(0, {hour}, {minute}, {second})"


def _unpack(packed: str) -> list[str]:
    # Digits are taken by position; lpad also cuts longer numbers to their first six.
    whole = f"CAST({packed} AS BIGINT)"
    negative = f"concat('-', lpad(substring(CAST({whole} AS STRING), 2), 5, '0'))"
    digits = f"CASE WHEN {whole} < 0 THEN {negative} ELSE lpad(CAST({whole} AS STRING), 6, '0') END"
    return [f"CAST(substring({digits}, {start}, 2) AS INT)" for start in (1, 3, 5)]
