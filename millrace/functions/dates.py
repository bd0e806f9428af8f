"""Date helpers. Every date is computed in the session time zone (UTC)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField

from .text import col_of


def as_date(value: str | _dt.date | Column) -> Column:
    """A DATE column from a Python date, ISO text or a column (``%Y-%m-%d``)."""
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.to_date(F.lit(value), "yyyy-MM-dd")


def on_day(c: str | Column, day: str | _dt.date, field: StructField | None = None) -> Column:
    """Row filter for one calendar day.

    On a DATE column this is an equality; on a timestamp it is a half-open range
    ``[day, day+1)`` so the predicate stays a plain comparison on the column and
    reaches the parquet scan as a pushed filter (``to_date(ts) = d`` would not).
    """
    c = col_of(c)
    if field is not None and isinstance(field.dataType, DateType):
        return c == as_date(day)
    start = as_date(day)
    return (c >= start) & (c < F.date_add(start, 1))


def in_days(c: str | Column, first: str | _dt.date, last: str | _dt.date,
            field: StructField | None = None) -> Column:
    """Row filter for the inclusive day range ``[first, last]`` (pushdown-friendly)."""
    c = col_of(c)
    if field is not None and isinstance(field.dataType, DateType):
        return c.between(as_date(first), as_date(last))
    return (c >= as_date(first)) & (c < F.date_add(as_date(last), 1))


def compact_date(c: str | Column) -> Column:
    """``%Y%m%d`` text of a date or timestamp."""
    return F.date_format(col_of(c), "yyyyMMdd")


def iso_date(c: str | Column) -> Column:
    """``%Y-%m-%d`` text of a date or timestamp."""
    return F.date_format(col_of(c), "yyyy-MM-dd")


def utc_stamp(c: str | Column, *, wall_clock: bool = False) -> Column:
    """``YYYY-MM-DD HH:mm:ss +00:00`` text of an instant, in UTC whatever the
    session time zone. ``wall_clock=True`` takes a timestamp without time zone
    as a UTC wall-clock time."""
    c = col_of(c)
    if not wall_clock:
        # instant -> session wall clock -> UTC wall clock
        c = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(" +00:00"))


def days_between(first: Column, last: Column) -> Column:
    """Array of every day from ``first`` to ``last`` inclusive; empty when first > last.

    ``sequence`` would count downwards for first > last, so guard it.
    """
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))
