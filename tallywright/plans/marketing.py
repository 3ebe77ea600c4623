"""Purchase cohorts, acquisition channels and revenue concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.functions.dates import month_diff, truncate
from tallywright.functions.money import ratio, total
from tallywright.operators.calendar import each_number
from tallywright.operators.history import cohort_purchases
from tallywright.operators.ranking import with_ntile


def cohort_activity(history: DataFrame) -> DataFrame:
    """One row per cohort and active month: customers, orders, revenue.

    An order is one row and a customer has one first purchase, so orders and
    first purchases are plain counts; only customers need a distinct count.
    """
    first = F.col("is_first_purchase") & F.col("user_id").isNotNull()
    return (
        cohort_purchases(history)
        .groupBy("cohort_month", "months_since_first_purchase")
        .agg(
            F.countDistinct("user_id").alias("active_customers"),
            F.count("order_id").alias("orders"),
            total(F.col("net_revenue")).alias("net_revenue"),
            total(F.col("net_gross_profit")).alias("net_gross_profit"),
            F.count_if(first).alias("first_purchases"),
        )
    )


def cohort_sizes(activity: DataFrame) -> DataFrame:
    """Customers per cohort."""
    return activity.groupBy("cohort_month").agg(F.sum("first_purchases").alias("cohort_customers"))


def cohort_max_offset(activity: DataFrame) -> DataFrame:
    """Last active month offset per cohort."""
    return activity.groupBy("cohort_month").agg(F.max("months_since_first_purchase").alias("max_offset"))


def cohort_grid(activity: DataFrame) -> DataFrame:
    """Every offset 0..last of each cohort, with its size."""
    return (
        cohort_sizes(activity)
        .join(cohort_max_offset(activity), "cohort_month")
        .select(
            "cohort_month",
            "cohort_customers",
            F.explode(each_number(F.col("max_offset"))).alias("months_since_first_purchase"),
        )
    )


def fill_cohort_months(activity: DataFrame, grid_end: str = "activity") -> DataFrame:
    """Adds cohort_customers and the idle months of each cohort as zeros.

    Each active month also emits the idle months up to the next one, which gives
    the full grid without joining the aggregate back to itself. Windows are over
    at most one row per calendar month.
    """
    cohort = Window.partitionBy("cohort_month")
    offset = F.col("months_since_first_purchase")
    following = F.lead(offset).over(cohort.orderBy(offset))
    if grid_end == "data":
        reached = F.add_months("cohort_month", offset.cast("int"))
        end = month_diff(F.max(reached).over(Window.partitionBy()), F.col("cohort_month"))
    elif grid_end == "activity":
        end = offset
    else:
        raise ValueError(f"grid_end must be 'activity' or 'data', not {grid_end!r}")
    spread = activity.withColumn("cohort_customers", F.sum("first_purchases").over(cohort)).withColumn(
        "_idle", each_number(F.coalesce(following - 1, end) - offset)
    )
    spread = spread.withColumn("_step", F.explode("_idle"))

    def here(name: str):
        return F.when(F.col("_step") == 0, F.col(name)).alias(name)

    return spread.select(
        "cohort_month",
        (offset + F.col("_step")).alias("months_since_first_purchase"),
        "cohort_customers",
        here("active_customers"),
        here("orders"),
        here("net_revenue"),
        here("net_gross_profit"),
    )


def mart_customer_cohorts(activity: DataFrame, cfg: Config) -> DataFrame:
    """One row per cohort and month offset: retention, revenue, cumulative value."""
    size = F.col("cohort_customers")
    revenue = F.coalesce(F.col("net_revenue"), F.lit(0)).cast("decimal(28,2)")
    so_far = (
        Window.partitionBy("cohort_month")
        .orderBy("months_since_first_purchase")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return fill_cohort_months(activity, cfg.cohort_grid_end).select(
        "cohort_month",
        "months_since_first_purchase",
        "cohort_customers",
        F.coalesce(F.col("active_customers"), F.lit(0)).alias("active_customers"),
        F.coalesce(F.col("orders"), F.lit(0)).alias("orders"),
        revenue.alias("net_revenue"),
        F.coalesce(F.col("net_gross_profit"), F.lit(0)).cast("decimal(28,2)").alias("net_gross_profit"),
        ratio(F.col("active_customers"), size, 4).alias("retention_rate"),
        ratio(F.col("net_revenue"), size, 2).alias("revenue_per_cohort_customer"),
        ratio(F.sum(revenue).over(so_far), size, 2).alias("cumulative_ltv"),
    )


def channel_month(customers: DataFrame) -> DataFrame:
    """Totals by registration month and traffic source."""
    return customers.groupBy(
        truncate(F.col("registered_date"), "month").alias("registration_month"), "traffic_source"
    ).agg(
        F.count("*").alias("customers_acquired"),
        F.count_if("has_purchased").alias("customers_who_purchased"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
        F.count_if("is_active").alias("still_active_customers"),
        F.sum("lifetime_orders").alias("lifetime_orders"),
        total(F.col("lifetime_net_revenue")).alias("lifetime_net_revenue"),
        total(F.col("lifetime_gross_profit")).alias("lifetime_gross_profit"),
    )


def mart_acquisition_channels(customers: DataFrame) -> DataFrame:
    """One row per registration month and traffic source; ratios of totals."""
    acquired, purchased = F.col("customers_acquired"), F.col("customers_who_purchased")
    return channel_month(customers).select(
        "*",
        ratio(purchased, acquired, 4).alias("conversion_rate"),
        ratio(F.col("repeat_customers"), purchased, 4).alias("repeat_rate"),
        ratio(F.col("lifetime_net_revenue"), acquired, 2).alias("revenue_per_acquired_customer"),
        ratio(F.col("lifetime_net_revenue"), purchased, 2).alias("revenue_per_purchasing_customer"),
        ratio(F.col("lifetime_orders"), purchased, 2).alias("orders_per_purchasing_customer"),
    )


def customer_deciles(customers: DataFrame) -> DataFrame:
    """Purchasing customers with their decile by lifetime revenue; ids settle ties."""
    buyers = customers.where("has_purchased").select("user_id", "lifetime_net_revenue")
    return with_ntile(
        buyers, 10, [F.col("lifetime_net_revenue").desc(), F.col("user_id").asc()], "revenue_decile"
    )


def revenue_concentration(customers: DataFrame) -> DataFrame:
    """Ten rows: customers, revenue and share of revenue per decile."""
    per_decile = (
        customer_deciles(customers)
        .groupBy("revenue_decile")
        .agg(F.count("*").alias("customers"), total(F.col("lifetime_net_revenue")).alias("revenue"))
    )
    all_revenue = F.sum("revenue").over(Window.partitionBy())
    return per_decile.select(
        "revenue_decile",
        "customers",
        F.round("revenue", 2).alias("revenue"),
        ratio(F.col("revenue"), all_revenue, 4).alias("pct_of_total_revenue"),
        ratio(F.col("revenue"), F.col("customers"), 2).alias("avg_ltv"),
    ).orderBy("revenue_decile")
