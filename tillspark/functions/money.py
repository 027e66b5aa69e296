"""Exact decimal money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillspark.constants import AMOUNT, RATIO, TOTAL


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Quantity times price, two decimals; NULL where it does not fit."""
    return F.round(quantity.cast(AMOUNT) * unit_price, 2).try_cast(AMOUNT)


def discount_amount(gross: Column, percent: Column) -> Column:
    """``percent`` is in percentage points. Decimal throughout, half-up."""
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    return F.round(gross * percent * hundredth, 2).try_cast(AMOUNT)


def total(amount: Column) -> Column:
    """Sum wide enough for a very large number of lines; zero over no rows."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast(TOTAL)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Exact ``part / whole`` rounded half-up; NULL where ``whole`` is zero."""
    quotient = F.try_divide(part.cast(TOTAL), whole.cast(TOTAL))
    return F.round(quotient, digits).cast(RATIO if digits == 2 else f"decimal(18,{digits})")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals."""
    return ratio(part.cast(TOTAL) * 100, whole)


def mean(amount: Column) -> Column:
    """Average rounded once, at two decimals."""
    return ratio(F.sum(amount), F.count(amount))
