"""Date and time helpers as Column expressions, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed formats. A single H reads both 3:05:07 and 03:05:07.
PARSE_TIME = "yyyy-MM-dd H:mm:ss"
DATE = "yyyy-MM-dd"
TIME = "yyyy-MM-dd HH:mm:ss"
DATE_KEY = "yyyyMMdd"
MINUTE_KEY = "yyyyMMddHHmm"
DATE_HOUR = "yyyy-MM-dd_HH"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_time(text: Column | str) -> Column:
    """Timestamp, or NULL for text that is no time."""
    return F.try_to_timestamp(_col(text), F.lit(PARSE_TIME))


def parse_date_key(text: Column | str) -> Column:
    """``yyyyMMdd`` as a date, or NULL."""
    return F.try_to_timestamp(_col(text), F.lit(DATE_KEY)).cast("date")


def before(first: Column | str, second: Column | str) -> Column:
    """Whether text time ``first`` lies before ``second``; false if either is unreadable."""
    return F.coalesce(parse_time(first) < parse_time(second), F.lit(False))


def after(first: Column | str, second: Column | str) -> Column:
    """Whether text time ``first`` lies after ``second``; false if either is unreadable."""
    return F.coalesce(parse_time(first) > parse_time(second), F.lit(False))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from timestamp ``start`` to ``end``."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def minus(first: Column | str, second: Column | str) -> Column:
    """Whole seconds by which text time ``first`` follows ``second``; 0 if either is unreadable."""
    return F.coalesce(seconds_between(parse_time(second), parse_time(first)), F.lit(0))


def date_hour(time: Column | str) -> Column:
    return F.date_format(_col(time), DATE_HOUR)


def format_date(time: Column | str) -> Column:
    return F.date_format(_col(time), DATE)


def format_time(time: Column | str) -> Column:
    return F.date_format(_col(time), TIME)


def format_date_key(time: Column | str) -> Column:
    return F.date_format(_col(time), DATE_KEY)


def format_minute(time: Column | str) -> Column:
    return F.date_format(_col(time), MINUTE_KEY)


def today() -> Column:
    return F.date_format(F.current_date(), DATE)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE)


def from_epoch_ms(millis: Column | str) -> Column:
    return F.timestamp_millis(_col(millis))
