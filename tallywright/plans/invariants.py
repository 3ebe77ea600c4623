"""Business assertions. Each returns the violating rows; empty means it holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.functions import fixed_values as fixed
from tallywright.functions.dates import day_diff
from tallywright.operators.checks import violations
from tallywright.operators.economics import revenue_by_order


# row rules -------------------------------------------------------------------
def cancelled_with_revenue() -> Column:
    return F.col("order_status").isin(fixed.CANCELLED, fixed.RETURNED) & (F.col("net_revenue") > 0)


def complete_without_items() -> Column:
    return F.col("is_revenue_complete") & ~F.col("has_line_items")


def revenue_without_items() -> Column:
    return ~F.col("has_line_items") & F.col("net_revenue").isNotNull()


def ordered_after(now: Column) -> Column:
    return F.col("ordered_at") > now


def cohort_not_full_at_start() -> Column:
    return (F.col("months_since_first_purchase") == 0) & (F.col("retention_rate") < 0.9999)


def bought_before_registration() -> Column:
    return F.col("first_order_date").isNotNull() & (F.col("first_order_date") < F.col("registered_date"))


def unknown_value_read_as_known() -> Column:
    """Every recognised order lacks economics, yet the average is a number."""
    orders = F.col("lifetime_orders")
    return (
        (orders > 0)
        & (orders == F.col("lifetime_orders_missing_economics"))
        & F.col("avg_order_value").isNotNull()
    )


def now_or_clamp(cfg: Config) -> Column:
    return F.current_timestamp() if cfg.clamp_ts is None else F.lit(cfg.clamp_ts.isoformat(sep=" ")).cast("timestamp")


#: name -> (mart, rule, columns to show)
ROW_INVARIANTS: dict[str, tuple[str, Callable[[Config], Column], tuple[str, ...]]] = {
    "cancelled_orders_have_zero_revenue": (
        "fct_orders", lambda cfg: cancelled_with_revenue(), ("order_id", "order_status", "net_revenue")),
    "complete_orders_have_items": (
        "fct_orders", lambda cfg: complete_without_items(), ("order_id", "ordered_date", "order_status", "items_ordered")),
    "incomplete_orders_have_null_revenue": (
        "fct_orders", lambda cfg: revenue_without_items(), ("order_id", "ordered_date", "net_revenue")),
    "no_future_orders": (
        "fct_orders", lambda cfg: ordered_after(now_or_clamp(cfg)), ("order_id", "ordered_at")),
    "cohort_starts_at_full_retention": (
        "mart_customer_cohorts", lambda cfg: cohort_not_full_at_start(), ("cohort_month", "retention_rate")),
    "first_order_not_before_registration": (
        "dim_customers", lambda cfg: bought_before_registration(), ("user_id", "registered_date", "first_order_date")),
    "unknown_value_is_not_zero": (
        "dim_customers", lambda cfg: unknown_value_read_as_known(),
        ("user_id", "lifetime_orders", "lifetime_orders_missing_economics", "lifetime_net_revenue", "avg_order_value")),
}


# frame checks ------------------------------------------------------------------
def trailing_volume(daily: DataFrame, cfg: Config) -> DataFrame:
    """Days with the average order count of the days before (current day excluded)."""
    before = Window.orderBy("revenue_date").rowsBetween(-cfg.volume_baseline_days, -1)
    return daily.select("revenue_date", "is_revenue_complete", "orders_placed").withColumn(
        "trailing_avg_orders", F.avg("orders_placed").over(before)
    )


def implausible_volume(daily: DataFrame, cfg: Config) -> DataFrame:
    """Complete days far above or below their own recent volume."""
    usual, placed = F.col("trailing_avg_orders"), F.col("orders_placed")
    odd = (placed > usual * cfg.volume_multiple) | (placed < usual * cfg.volume_floor)
    return (
        trailing_volume(daily, cfg)
        .where(F.col("is_revenue_complete") & (usual > cfg.volume_warm_up) & odd)
        .select(
            "revenue_date",
            "orders_placed",
            F.round(usual, 1).alias("trailing_avg_orders"),
            F.round(F.try_divide(placed, usual), 2).alias("ratio"),
        )
    )


def completeness_window(orders: DataFrame) -> DataFrame:
    """One row: last order date, last complete date and the days between."""
    return orders.agg(
        F.max("ordered_date").alias("max_order_date"),
        F.max(F.when(F.col("is_revenue_complete"), F.col("ordered_date"))).alias("complete_through"),
    ).withColumn("window_days", day_diff(F.col("max_order_date"), F.col("complete_through")))


def stale_completeness(orders: DataFrame, cfg: Config) -> DataFrame:
    """The window, when the boundary is missing or too far back."""
    return completeness_window(orders).where(
        F.col("complete_through").isNull() | (F.col("window_days") > cfg.max_window_days)
    )


def reconcile_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order revenue beside the sum of its items; orders without items drop out."""
    by_item = revenue_by_order(items).withColumnRenamed("net_revenue", "line_item_revenue")
    return (
        orders.select("order_id", F.col("net_revenue").alias("order_revenue"))
        .join(by_item, "order_id")
        .withColumn("difference", F.abs(F.col("order_revenue") - F.col("line_item_revenue")))
    )


def unreconciled_revenue(orders: DataFrame, items: DataFrame, tolerance: float = 0.01) -> DataFrame:
    return reconcile_revenue(orders, items).where(F.col("difference") > F.lit(str(tolerance)).cast("decimal(38,18)"))


def invariant(name: str, frames: Callable[[str], DataFrame], cfg: Config) -> DataFrame:
    """Violations of one named assertion."""
    if name in ROW_INVARIANTS:
        mart, rule, shown = ROW_INVARIANTS[name]
        return violations(frames(mart), rule(cfg)).select(*shown)
    if name == "complete_days_have_plausible_volume":
        return implausible_volume(frames("fct_daily_revenue"), cfg)
    if name == "completeness_window_is_sane":
        return stale_completeness(frames("fct_orders"), cfg)
    if name == "order_revenue_ties_to_items":
        return unreconciled_revenue(frames("fct_orders"), frames("fct_order_items"))
    raise KeyError(name)


FRAME_INVARIANTS = {
    "complete_days_have_plausible_volume": "fct_daily_revenue",
    "completeness_window_is_sane": "fct_orders",
    "order_revenue_ties_to_items": "fct_orders",
}
