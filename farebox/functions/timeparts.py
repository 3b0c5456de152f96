"""Calendar keys and durations.

Timestamps are session-time-zone timestamps; ``session.build_session`` pins
that zone to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_bucket(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def month_bucket(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def weekday_name(weekday: Column) -> Column:
    """Name of a ``weekday()`` number (0 = Monday).

    Aggregations group by the number and call this on the result, so that no
    text is formatted per input row.
    """
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), weekday + F.lit(1))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds of each instant, then the difference."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def clock_text(seconds: Column) -> Column:
    """Seconds as ``HH:MM:SS``; does not wrap at 24 hours and ignores the time zone."""
    size = F.abs(seconds)
    text = F.format_string(
        "%02d:%02d:%02d",
        F.floor(size / 3600),
        F.floor(size / 60) % 60,
        size % 60,
    )
    return F.when(seconds < 0, F.concat(F.lit("-"), text)).when(seconds >= 0, text)


def shift_hours(ts: Column, hours: int) -> Column:
    """Fixed-offset shift; the day rolls over by itself."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))
