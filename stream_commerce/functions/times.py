"""Epoch and text times, all independent of the session time zone.

Text is cut out of the `yyyy-MM-dd HH:mm:ss[.ffffff]` form of a zone-less timestamp: a cast plus
substrings stays inside generated code, and `date_format` would first pass the value through the
session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHANGHAI = "Asia/Shanghai"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def floor_div(value: Column, width: int) -> Column:
    """Exact integer quotient rounded down; a double quotient could round up at a boundary."""
    value = value.cast("bigint")
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def _epoch_seconds(ts: Column | str) -> Column:
    # The difference of two zone-less timestamps is taken without a zone; `timestamp_diff` would
    # cast both to the session zone first.
    return (_col(ts) - _epoch()).cast("interval second").cast("decimal(20,6)")


def epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a zone-less (UTC) timestamp, rounded down."""
    return F.floor(_epoch_seconds(ts) * 1000).cast("bigint")


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since the epoch of a zone-less (UTC) timestamp."""
    return (_epoch_seconds(ts) * 1_000_000).cast("bigint")


def local_time(ms: Column | str, zone: str = SHANGHAI) -> Column:
    """Wall-clock time (zone-less timestamp) in `zone` at an epoch millisecond.

    `from_utc_timestamp` shifts the instant with a zone resolved once; `convert_timezone` looks the
    zone up for every row and takes several times as long.
    """
    shifted = F.from_utc_timestamp(F.timestamp_millis(_col(ms).cast("bigint")), zone)
    return F.timestamp_add("MICROSECOND", F.unix_micros(shifted), _epoch())


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def date_of(local: Column | str) -> Column:
    """`yyyy-MM-dd` of a wall-clock time."""
    return F.substring(_col(local).cast("string"), 1, 10)


def hour_of(local: Column | str) -> Column:
    """`HH` of a wall-clock time."""
    return F.substring(_col(local).cast("string"), 12, 2)


def minute_of(local: Column | str) -> Column:
    """`yyyy-MM-dd'T'HH:mm` of a wall-clock time."""
    text = _col(local).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 5))


def second_of(local: Column | str) -> Column:
    """`yyyy-MM-dd'T'HH:mm:ss` of a wall-clock time."""
    text = _col(local).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def parse_local(text: Column | str) -> Column:
    """`yyyy-MM-dd HH:mm:ss` text as a zone-less timestamp; null for any other text."""
    text = _col(text)
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def age_in_years(birthday: Column | str, as_of: Column | str) -> Column:
    """Whole days between the two dates divided by 365, leap days not corrected; 0 if unknown."""
    days = F.date_diff(_col(as_of).cast("date"), _col(birthday).try_cast("date"))
    return F.coalesce((days / 365).cast("int"), F.lit(0))
