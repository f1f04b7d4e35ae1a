"""Calendar and timestamp expressions.

``as_of`` is always a parameter: an ISO day, a ``date``, a ``Column`` or None
for the current day. All of them fold to a literal, so the predicates built
here reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = str | dt.date | Column | None


def as_day(value: Day) -> Column:
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def as_instant(value: str | dt.datetime | Column | None) -> Column:
    """ISO-8601 text (with or without offset), a datetime, or now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")


def between_days(column: str, start: Day, end: Day) -> Column:
    """Inclusive on both ends."""
    return F.col(column).between(as_day(start), as_day(end))


def within_last(column: str, as_of: Day, days: int) -> Column:
    return F.col(column) >= F.date_sub(as_day(as_of), days)


def day_before(as_of: Day, days: int = 1) -> Column:
    return F.date_sub(as_day(as_of), days)


def on_day(column: str, day: Day) -> Column:
    """``to_date(column) == day`` as a half-open range, which can be pushed down."""
    start = as_day(day)
    return (F.col(column) >= start.cast("timestamp")) & (
        F.col(column) < F.date_add(start, 1).cast("timestamp")
    )


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds, truncated."""
    return F.timestamp_diff("SECOND", start, end)


def iso_text(column: Column) -> Column:
    """UTC ISO-8601 text of a timestamp, with microseconds and offset."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
