"""Sums and means of money that do not depend on the order of rows.

Adding doubles gives another last digit for another partitioning. Amounts in whole cents are
therefore summed as two BIGINT parts, their low 24 bits and the others, which become one decimal per
group; each part holds ten billion of the largest amounts. An amount that is not in
whole cents (or is NaN, infinite or over 90 trillion) is summed as the double it is. All are
ordinary partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this, cents are below 2^53, where doubles are exact whole numbers.
_LIMIT = 9e13
_BITS = 24
_WIDE = "decimal(38,0)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _cents_and_rest(amount: Column) -> tuple[Column, Column]:
    """The sum in cents of the amounts in whole cents, as a decimal, and that of the others."""
    scaled = F.rint(amount * 100)
    cents = F.when((F.abs(amount) <= _LIMIT) & (scaled / 100 == amount), scaled.cast("bigint"))
    highs, lows = F.sum(F.shiftright(cents, _BITS)), F.sum(cents.bitwiseAND(F.lit((1 << _BITS) - 1)))
    unit = F.lit(1 << _BITS).cast("decimal(8,0)")
    total = highs.cast("decimal(20,0)") * unit + lows.cast("decimal(20,0)")
    return total, F.sum(F.when(cents.isNull(), amount))


def _amount(cents: Column) -> Column:
    return (cents * F.lit("0.01").cast("decimal(2,2)")).cast("double")


def money_sum(amount: Column | str) -> Column:
    """Sum of a DOUBLE money column, exact for whole cents; NULL over no values."""
    whole, rest = _cents_and_rest(_col(amount))
    exact = _amount(whole)
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def money_avg(amount: Column | str) -> Column:
    """Unrounded mean; NULL over no values."""
    amount = _col(amount)
    n = F.count(amount)
    return F.when(n > 0, money_sum(amount) / n)


def money_avg_rounded(amount: Column | str) -> Column:
    """Mean rounded half up (away from zero) to cents, in decimal arithmetic where it can be.

    With S cents over n values that is (2|S| + n) div 2n; taking the remainder off first makes the
    division exact.
    """
    amount = _col(amount)
    whole, rest = _cents_and_rest(amount)
    n = F.count(amount)
    twice = (n * 2).cast("decimal(20,0)")
    above = (F.abs(whole) * 2).cast(_WIDE) + n.cast(_WIDE)
    cents = ((above - above % twice).cast(_WIDE) / twice).cast(_WIDE)
    half_up = cents.cast("double") * F.signum(whole) / 100
    return F.when(n > 0, F.when(rest.isNull(), half_up).otherwise(F.round(money_avg(amount), 2)))
