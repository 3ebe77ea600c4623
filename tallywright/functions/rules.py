"""Business rules as expressions, each defined once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywright.functions import fixed_values as fixed


def status_flags(status: Column, revenue_statuses: Iterable[str]) -> dict[str, Column]:
    return {
        "is_revenue_recognised": status.isin(*revenue_statuses),
        "is_cancelled": status == fixed.CANCELLED,
        "is_returned": status == fixed.RETURNED,
    }


def banded(value: Column, bands: Sequence[tuple[int | None, str]]) -> Column:
    """Label of the first band whose upper bound exceeds the value.

    The open-ended last band also takes nulls, because no comparison holds.
    """
    *bounded, (_, rest) = bands
    (bound, label), *more = bounded
    chain = F.when(value < bound, label)
    for bound, label in more:
        chain = chain.when(value < bound, label)
    return chain.otherwise(rest)


def age_band(age: Column) -> Column:
    return banded(age, fixed.AGE_BANDS)


def price_tier(list_price: Column) -> Column:
    return banded(list_price, fixed.PRICE_TIERS)


def customer_status(orders: Column, idle_days: Column, active_days: int, lapsing_days: int) -> Column:
    """Segment by recognised order count and days since the last one."""
    return (
        F.when(F.coalesce(orders, F.lit(0)) == 0, fixed.NEVER_PURCHASED)
        .when((idle_days <= active_days) & (orders == 1), fixed.ACTIVE_NEW)
        .when(idle_days <= active_days, fixed.ACTIVE_REPEAT)
        .when(idle_days <= lapsing_days, fixed.LAPSING)
        .otherwise(fixed.CHURNED)
    )
