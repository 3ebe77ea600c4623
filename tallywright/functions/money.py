"""Exact money and ratios.

Amounts are ``decimal(18,2)``. Ratios are divided as decimals, so a tie such as
100.01 / 2 rounds half away from zero instead of depending on binary floats.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def money(c: Column) -> Column:
    return F.round(c.cast("decimal(38,9)"), 2).cast(MONEY)


def cents(c: Column) -> Column:
    """The amount as a whole number of cents: sums of longs stay in registers,
    sums of wide decimals allocate."""
    return (c * 100).cast("bigint")


def from_cents(c: Column) -> Column:
    return (c * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def total(c: Column) -> Column:
    """Exact sum of an amount."""
    return from_cents(F.sum(cents(c)))


def net_revenue(price: Column, status: Column, revenue_statuses: Iterable[str]) -> Column:
    """The price when the status counts toward revenue, else zero."""
    return F.when(status.isin(*revenue_statuses), price).otherwise(F.lit(0)).cast(MONEY)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator, rounded; null where the denominator is 0 or null.

    Both sides become decimal(22,2): room for totals up to 10**20, and a quotient
    with sixteen decimals, so rounding to nine or fewer does not round twice.
    """
    wide = "decimal(22,2)"
    return F.round(F.try_divide(numerator.cast(wide), denominator.cast(wide)), digits)
