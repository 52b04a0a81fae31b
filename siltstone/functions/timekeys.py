"""Keys into the calendar and time-of-day dimensions, and day-range predicates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, functions as F


def date_key(time: Column | str) -> Column:
    """``yyyyMMdd`` as an integer, by arithmetic rather than by formatting text."""
    return F.year(time) * 10000 + F.month(time) * 100 + F.dayofmonth(time)


def time_key(time: Column | str) -> Column:
    """Minute of the day, 0 to 1439."""
    return F.hour(time) * 60 + F.minute(time)


def day_number(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def in_days(partitions: Sequence[str], first: date | None, last: date | None) -> Column:
    """Predicate on (year, month, day) partition columns for an inclusive day range.

    It names partition columns only, so the scan prunes folders with it.  The
    plain bounds on the year come first to keep the common case readable in plans.
    """
    year, month, day = (F.col(c) for c in partitions)
    number = year * 10000 + month * 100 + day
    keep = F.lit(True)
    if first is not None:
        keep = keep & (year >= first.year) & (number >= day_number(first))
    if last is not None:
        keep = keep & (year <= last.year) & (number <= day_number(last))
    return keep
