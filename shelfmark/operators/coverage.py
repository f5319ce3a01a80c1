"""Days covered by intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.dates import days_spanned


def covered_days(intervals: DataFrame, start: str, end: str, day: str) -> DataFrame:
    """Distinct days inside any [start, end], both ends included.

    A reversed interval covers the same days as the straight one; a NULL end covers none.
    Intervals are first reduced, before any shuffle, to the longest one per first day. Each of
    those is then expanded only up to the next first day, or as far as it or an earlier one reaches,
    so every day comes out once, however many intervals run to a far end date. The window holds one
    row per first day, which the calendar bounds.
    """
    spans = (
        intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull())
        .groupBy(F.least(start, end).alias("_first"))
        .agg(F.max(F.greatest(start, end)).alias("_last"))
    )
    in_order = Window.orderBy("_first")
    reached = F.max("_last").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    before_next = F.date_sub(F.lead("_first").over(in_order), 1)
    return spans.select("_first", F.least(reached, before_next).alias("_until")).select(
        F.explode(days_spanned("_first", "_until")).alias(day)
    )
