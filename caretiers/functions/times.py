"""Timestamp expressions and injectable clocks."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def instant(now: datetime | None) -> Column:
    """The given moment (naive values are UTC), or the start of the running query."""
    if now is None:
        return F.current_timestamp()
    return F.lit(now.isoformat(sep=" ")).cast("timestamp")


def day_start(as_of: date | str | None, days_back: int = 1) -> Column:
    """Midnight a number of days before ``as_of`` (default: today)."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.date_sub(day, days_back)


def as_timestamp(column: str) -> Column:
    """ISO-8601 text, with or without offset, as timestamp; NULL when it is malformed."""
    return F.try_to_timestamp(F.col(column))


def minutes_between(start: str, end: str) -> Column:
    """Whole seconds from start to end, in minutes; NULL when either is missing."""
    return (F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))) / F.lit(60)
