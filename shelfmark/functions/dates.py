"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "month")


def year_start(day: Column | str) -> Column:
    """First day of the year, as DATE."""
    return F.trunc(day, "year")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; negative when they are reversed."""
    return F.datediff(end, start)


def days_spanned(start: Column | str, end: Column | str) -> Column:
    """Every day from start to end, both included; counts down when they are reversed."""
    return F.sequence(start, end)
