"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def previous_month(as_of: Column) -> tuple[Column, Column]:
    """First and last day of the calendar month before ``as_of``."""
    start = F.trunc(F.add_months(F.to_date(as_of), -1), "month")
    return start, F.last_day(start)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days, ignoring the time of day."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def fractional_days(later: Column, earlier: Column) -> Column:
    """Elapsed days with a fraction, from whole seconds; NULL if a side is."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(86400)
