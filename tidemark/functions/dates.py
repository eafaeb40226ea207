"""Date and time expressions.

Everything here works on ``TIMESTAMP_NTZ`` without passing through the
zoned timestamp type, so results do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Weekday numbers with Sunday = 0, and the hours that still count as day.
SATURDAY, SUNDAY = 6, 0
FIRST_DAY_HOUR, LAST_DAY_HOUR = 6, 20


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(ts: Column | str) -> Column:
    """Weekday number, Sunday = 0 .. Saturday = 6 (Spark's own starts at 1)."""
    return F.dayofweek(_col(ts)) - F.lit(1)


def day_name(ts: Column | str) -> Column:
    """Three-letter weekday name."""
    return F.dayname(_col(ts))


def month_name(ts: Column | str) -> Column:
    """Three-letter month name."""
    return F.monthname(_col(ts))


def day_start(ts: Column | str) -> Column:
    """Midnight of the day, as a zone-free timestamp."""
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def month_start(ts: Column | str) -> Column:
    """Midnight of the first day of the month, as a zone-free timestamp."""
    return F.trunc(F.to_date(_col(ts)), "month").cast("timestamp_ntz")


def calendar_days(start: Column | str, end: Column | str) -> Column:
    """Number of midnights crossed from ``start`` to ``end`` (not elapsed 24 h periods)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def seconds_since(origin: dt.date, ts: Column | str) -> Column:
    """Whole seconds from midnight of ``origin`` to ``ts``."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit(origin)).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.when(day_of_week(ts).isin(SATURDAY, SUNDAY), F.lit(1)).otherwise(F.lit(0))


def is_night(ts: Column | str) -> Column:
    """1 before 06:00 and from 21:00 on, else 0 (20:xx still counts as day)."""
    hour = F.hour(_col(ts))
    return F.when((hour < FIRST_DAY_HOUR) | (hour > LAST_DAY_HOUR), F.lit(1)).otherwise(F.lit(0))


def parse_us_date(text: Column | str) -> Column:
    """``MM/DD/YYYY`` text to a zone-free timestamp at midnight."""
    return F.to_timestamp_ntz(_col(text), F.lit("MM/dd/yyyy"))


def as_moment(value: dt.date | dt.datetime | str) -> dt.datetime:
    """A range bound as a time; text may be ISO (``2024-01-31[ hh:mm:ss]``) or ``MM/DD/YYYY``."""
    if isinstance(value, str):
        return dt.datetime.strptime(value, "%m/%d/%Y") if "/" in value else dt.datetime.fromisoformat(value)
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def as_bound(value: dt.date | dt.datetime | str) -> Column:
    """A literal range bound that compares with ``TIMESTAMP_NTZ`` without a cast of the column.

    The bound (see ``as_moment``) is folded to a literal, so the comparison still reaches the file scan.
    """
    return F.lit(as_moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def as_date_bound(value: dt.date | dt.datetime | str) -> Column:
    """The day of ``value`` at midnight, as a bound for timestamp columns."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return as_bound(dt.date(value.year, value.month, value.day))
