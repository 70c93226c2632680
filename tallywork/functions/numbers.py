"""Numbers: exact money sums and lenient casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column) -> Column:
    """Two exact places: sums then do not depend on the order of the rows."""
    return amount.cast("decimal(18,2)")


def money_sum(amount: Column) -> Column:
    return F.sum(money(amount)).cast("double")


def number_or_null(text: Column) -> Column:
    """Text as a number, null where it is not one (a plain cast raises in ANSI mode)."""
    return text.try_cast("double")


def compounded(rate: Column, periods: Column, places: int) -> Column:
    """What one becomes at a rate over a number of periods."""
    return F.round(F.pow(1 + rate, periods), places)
