"""Exact money arithmetic.

Amounts are decimals inside the package and become doubles only at the edge.
Averages and shares are rounded half up on whole numbers, so the result does
not depend on the order of summation or on binary fractions.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"
WHOLE = "decimal(38,0)"


def money(value: Column | str) -> Column:
    """An amount with two decimal places."""
    column = F.col(value) if isinstance(value, str) else value
    return column.cast(AMOUNT)


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``numerator / denominator`` rounded half away from zero, exactly.

    The numerator may carry at most ``digits`` decimal places; the result is
    NULL for a zero or NULL denominator.
    """
    scale = 10**digits
    scaled = (numerator * F.lit(scale)).cast(WHOLE)
    parts = denominator.cast(WHOLE)
    nearest = F.call_function("div", F.abs(scaled) * 2 + parts, parts * 2)
    signed = F.when(scaled < 0, -nearest).otherwise(nearest)
    return F.when(denominator > 0, signed.cast("decimal(20,0)") / F.lit(scale)).cast(
        f"decimal(22,{digits})"
    )


def average(total: Column, n: Column) -> Column:
    """Average amount from a total and a row count."""
    return rounded_ratio(total, n, 2)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; both with at most two decimals."""
    # Both sides in cents, so the denominator is a whole number.
    return rounded_ratio(part.cast("decimal(30,2)") * 10000, whole.cast("decimal(30,2)") * 100, 2)


def rank_percent(ahead: Column, others: Column) -> Column:
    """``ahead`` of ``others`` rows as a percentage with two decimals.

    Same rounding on plain 64-bit numbers, for use on every row of a table.
    """
    hundredths = F.call_function("div", ahead * 20_000 + others, others * 2)
    return (hundredths.cast("decimal(9,0)") * F.lit(Decimal("0.01"))).cast("decimal(7,2)")
