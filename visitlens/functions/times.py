"""Time helpers. Times are ``yyyy-MM-dd HH:mm:ss`` text or epoch milliseconds, in UTC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of the data.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
BATCH_STAMP_FORMAT = "yyyyMMddHHmmss"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"

DATE_PARTS = ("year", "month", "day", "hour", "minute", "second", "millisecond")


def to_time(c: Column, pattern: str = TIME_FORMAT) -> Column:
    """Text to timestamp; text that does not fit the pattern gives null."""
    return F.try_to_timestamp(c, F.lit(pattern))


def day_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp, without a formatter."""
    return ts.cast("date").cast("string")


def format_millis(c: Column, pattern: str = TIME_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(c), pattern)


def parse_millis(c: Column, pattern: str = TIME_FORMAT) -> Column:
    return F.unix_millis(to_time(c, pattern))


def date_part(millis: Column, part: str) -> Column:
    if part not in DATE_PARTS:
        raise ValueError(f"unknown date part {part!r}")
    if part == "millisecond":
        return F.pmod(millis, F.lit(1000)).cast("int")
    ts = F.timestamp_millis(millis)
    if part == "day":
        return F.dayofmonth(ts)
    return getattr(F, part)(ts)


def is_before(first: Column, second: Column) -> Column:
    return F.coalesce(to_time(first) < to_time(second), F.lit(False))


def is_after(first: Column, second: Column) -> Column:
    return F.coalesce(to_time(first) > to_time(second), F.lit(False))


def seconds_between(first: Column, second: Column) -> Column:
    """Whole seconds of ``first - second``; 0 if either is not a time."""
    difference = F.unix_seconds(to_time(first)) - F.unix_seconds(to_time(second))
    return F.coalesce(difference, F.lit(0)).cast("int")


def date_hour(c: Column) -> Column:
    return F.date_format(to_time(c), DATE_HOUR_FORMAT)


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_KEY_FORMAT)


def today(current: date | Column | None = None) -> Column:
    return F.date_format(_day(current), DATE_FORMAT)


def yesterday(current: date | Column | None = None) -> Column:
    return F.date_format(F.date_sub(_day(current), 1), DATE_FORMAT)


def _day(current: date | Column | None) -> Column:
    """The given day, or the session's current one."""
    if current is None:
        return F.current_date()
    return current if isinstance(current, Column) else F.lit(current)
