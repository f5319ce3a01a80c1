"""Guarded divisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """numerator / denominator rounded to `places`; 0 when the denominator is 0 or NULL."""
    return F.when(denominator != 0, F.round(numerator / denominator, places)).otherwise(
        F.lit(0.0)
    )


def pct_change(value: Column, base: Column, places: int = 2) -> Column:
    """(value - base) / base in percent; 0 when the base is NULL, zero or negative."""
    return F.when(base > 0, F.round((value - base) / base * 100, places)).otherwise(F.lit(0.0))
