"""How far the data is complete, derived from orders whose items are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.config import Config


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders no item refers to. Deduplicating the item keys first keeps an order
    with very many lines from weighing on the join."""
    return orders.join(items.select("order_id").distinct(), "order_id", "left_anti")


def first_gap(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row: the earliest order date with an order that has no items."""
    return orders_without_items(orders.select("order_id", "ordered_date"), items).agg(
        F.min("ordered_date").alias("first_incomplete_date")
    )


def latest_order_date(orders: DataFrame, name: str = "as_of_date") -> DataFrame:
    """One row: the last order date in the data."""
    return orders.agg(F.max("ordered_date").alias(name))


def completeness_boundary(orders: DataFrame, items: DataFrame, cfg: Config) -> DataFrame:
    """One row: the last day whose figures can be trusted.

    The day before the first gap (or the last order date when there is none),
    backed off by the settling days.
    """
    last_seen = F.coalesce(F.date_sub("first_incomplete_date", 1), F.col("max_order_date"))
    return with_one_row(first_gap(orders, items), latest_order_date(orders, "max_order_date")).select(
        F.date_sub(last_seen, cfg.settling_days).alias("complete_through")
    )


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (always exactly one row).

    As scalar subqueries they run once, reach every task as constants, and vanish
    when a later step does not read them.
    """
    return df.select("*", *(one_row.select(name).scalar().alias(name) for name in one_row.columns))
