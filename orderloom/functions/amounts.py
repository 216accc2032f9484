"""Money as whole cents.

Sums of ``decimal(14,2)`` leave the range of a machine word and are several times
slower than sums of integers. Cents are exact as well, and stay in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums are kept in two parts, so that they cannot overflow.
SPLIT = 1_000_000


def _div(column: Column, by: int) -> Column:
    """Whole-number division; ``/`` would go through doubles."""
    return F.call_function("div", column, F.lit(by))


def cents(amount: Column | str) -> Column:
    """Cents of an amount with at most two decimals."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return F.rint(column * 100).cast("long")


def from_cents(amount: Column | str, digits: int = 14) -> Column:
    column = F.col(amount) if isinstance(amount, str) else amount
    return (column.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal({digits},2)")


def as_double(amount: Column | str) -> Column:
    """The amount as the nearest double, for ratios."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.cast("double") / 100


def discount_cents(gross: Column, rate: Column) -> Column:
    """``rate`` (a fraction of two decimals) of ``gross`` cents, rounded half away from zero."""
    percent = F.rint(rate * 100).cast("long")
    return _div(gross * percent + F.when(gross < 0, -50).otherwise(50), 100)


def total_cents(amount: Column | str, digits: int = 20) -> Column:
    """Exact sum of cents as a decimal amount, of whatever size."""
    column = F.col(amount) if isinstance(amount, str) else amount
    high, low = F.sum(_div(column, SPLIT)), F.sum(column % SPLIT)
    whole = high.cast("decimal(22,0)") * F.lit(SPLIT).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    return (whole * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal({digits},2)")
