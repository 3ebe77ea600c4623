"""Gapless calendars and filling gaps in day- or month-grain frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.functions.dates import truncate


def each_day(first: Column, last: Column) -> Column:
    """Array of the days from first to last; null (no rows) when reversed."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def each_number(last: Column) -> Column:
    """Array 0..last; null (no rows) when negative, where sequence counts down."""
    return F.when(last >= 0, F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")))


def spine_between(bounds: DataFrame, first: str, last: str, name: str = "date_day") -> DataFrame:
    """One row per day between two date columns of a one-row frame."""
    return bounds.select(F.explode(each_day(F.col(first), F.col(last))).alias(name))


def with_periods(days: DataFrame, cfg: Config, day: str = "date_day") -> DataFrame:
    """Adds the start of the week, month, quarter and year of each day."""
    return days.select(
        day,
        *(
            truncate(F.col(day), grain, cfg.week_start).alias(f"date_{grain}")
            for grain in ("week", "month", "quarter", "year")
        ),
    )


def time_spine(spark: SparkSession, cfg: Config) -> DataFrame:
    """The project calendar: every day of the analysis window and beyond."""
    bounds = spark.range(1).select(
        F.lit(cfg.analysis_start).alias("first"), F.lit(cfg.spine_end).alias("last")
    )
    return with_periods(spine_between(bounds, "first", "last"), cfg)


def order_date_bounds(orders: DataFrame) -> DataFrame:
    """One row: first and last order date."""
    return orders.agg(F.min("ordered_date").alias("start_date"), F.max("ordered_date").alias("end_date"))


def fill_days(daily: DataFrame, day: str) -> DataFrame:
    """Insert the missing days of a day-grain frame, marked ``is_gap``.

    Each day also emits the days up to its successor, so the calendar comes out
    of the aggregated frame itself: no second pass over the facts, no join. The
    window is unpartitioned, but over one row per calendar day.
    """
    in_order = Window.orderBy(day)
    following = F.lead(day).over(in_order)
    last = F.coalesce(F.date_sub(following, 1), F.col(day))
    rest = [c for c in daily.columns if c != day]
    spread = daily.withColumn("_last", last).withColumn("_day", F.explode(each_day(F.col(day), F.col("_last"))))
    return spread.select(
        F.col("_day").alias(day),
        (F.col("_day") != F.col(day)).alias("is_gap"),
        *(F.when(F.col("_day") == F.col(day), F.col(c)).alias(c) for c in rest),
    )
