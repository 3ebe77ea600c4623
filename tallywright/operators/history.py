"""Order and purchase sequences per customer, and purchase cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions.dates import month_diff
from tallywright.operators.scan import prefix_sums


def order_sequence(orders: DataFrame) -> DataFrame:
    """Order grain, narrow: the order's number, its number among purchases, first and latest purchase.

    Numbers come from a prefix scan over (customer, time, order id), so neither a
    customer nor a day with a large share of the rows lands in one task. Orders
    without a customer are numbered among themselves.
    """
    bought = F.col("is_revenue_recognised")
    bought_at = F.when(bought, F.col("ordered_at"))
    return prefix_sums(
        orders.select("order_id", "user_id", "ordered_at", "is_revenue_recognised"),
        ["user_id"],
        ["ordered_at", "order_id"],
        {"order_seq": F.lit(1), "purchases": F.when(bought, 1).otherwise(0)},
        {"first_purchase_at": F.min(bought_at), "latest_purchase_at": F.max(bought_at)},
    ).select(
        "order_id", "order_seq", F.when(bought, F.col("purchases")).alias("purchase_seq"), "first_purchase_at", "latest_purchase_at"
    )


def sequence_orders(orders: DataFrame) -> DataFrame:
    """Adds order_seq, purchase_seq, first/latest purchase and cohort columns.

    The numbers are taken on a narrow frame and joined by the order's key: the wide
    rows are shuffled once, on the key that their economics need as well.
    """
    cohort = F.trunc(F.to_date("first_purchase_at"), "month")
    seq = F.col("purchase_seq")
    return orders.join(order_sequence(orders), "order_id", "left").select(
        *orders.columns,
        "order_seq",
        "purchase_seq",
        "first_purchase_at",
        "latest_purchase_at",
        (seq == 1).alias("is_first_purchase"),
        (seq > 1).alias("is_repeat_purchase"),
        cohort.alias("cohort_month"),
        month_diff(F.col("ordered_date"), cohort).alias("months_since_first_purchase"),
    )


def join_economics(orders: DataFrame, rollup: DataFrame) -> DataFrame:
    """Orders with their rolled-up economics; null, not 0, where no item exists."""
    return orders.join(rollup, "order_id", "left")


def order_history(orders: DataFrame, rollup: DataFrame) -> DataFrame:
    """Order grain: sequence, cohort and the order's own economics."""
    return join_economics(sequence_orders(orders), rollup.select("order_id", "net_revenue", "net_gross_profit", "units_sold")).select(
        "order_id",
        "user_id",
        "order_status",
        "is_revenue_recognised",
        "is_returned",
        "is_cancelled",
        "ordered_at",
        "ordered_date",
        "ordered_month",
        "net_revenue",
        "net_gross_profit",
        "units_sold",
        "order_seq",
        "purchase_seq",
        "first_purchase_at",
        "latest_purchase_at",
        "is_first_purchase",
        "is_repeat_purchase",
        "cohort_month",
        "months_since_first_purchase",
    )


def cohort_purchases(history: DataFrame) -> DataFrame:
    """Recognised orders of customers that belong to a cohort."""
    return history.where(F.col("cohort_month").isNotNull() & F.col("is_revenue_recognised"))
