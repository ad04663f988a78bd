"""Calendar expressions. Weeks run Monday to Sunday and carry the closing Sunday's date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def closing_sunday(day: Column) -> Column:
    """The first Sunday on or after ``day``."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def latest_sunday(day: Column) -> Column:
    """The last Sunday on or before ``day``."""
    return F.date_sub(day, (F.dayofweek(day) + 6) % 7)


def as_of_day(as_of: str | dt.date | Column | None) -> Column:
    """The reporting day: an argument, so that a run can be repeated; today by default."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def parse_day(text: Column) -> Column:
    """ISO text as a date; NULL where it is no date."""
    return F.try_to_date(text, "yyyy-MM-dd")


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def span_days(first: Column, last: Column) -> Column:
    """Days from ``first`` to ``last``, both counted."""
    return F.datediff(last, first) + 1


def week_series(first: Column, last: Column) -> Column:
    """Array of dates one week apart, both ends included."""
    return F.sequence(first, last, F.expr("interval 7 days"))
