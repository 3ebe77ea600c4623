"""Calendar arithmetic on dates (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def day_diff(later: Column, earlier: Column) -> Column:
    """Calendar days from ``earlier`` to ``later``, whatever the time of day."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def month_diff(later: Column, earlier: Column) -> Column:
    """Calendar months from ``earlier`` to ``later``; negative when reversed."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("bigint")


def week_of(d: Column, week_start: str = "monday") -> Column:
    if week_start == "monday":
        return F.trunc(d, "week")
    if week_start == "sunday":
        return F.date_sub(d, F.dayofweek(d) - 1)
    raise ValueError(f"week_start must be 'monday' or 'sunday', not {week_start!r}")


def truncate(d: Column, grain: str, week_start: str = "monday") -> Column:
    if grain == "day":
        return F.to_date(d)
    if grain == "week":
        return week_of(d, week_start)
    if grain in GRAINS:
        return F.trunc(d, grain)
    raise ValueError(f"unknown grain {grain!r}; choose one of {GRAINS}")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")
