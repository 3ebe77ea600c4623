"""Daily revenue and product performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.dates import day_name, is_weekend, truncate, week_of
from tallywright.functions.fixed_values import SAME_WEEKDAY_LAST_YEAR_DAYS
from tallywright.functions.money import ratio, total
from tallywright.operators.calendar import fill_days
from tallywright.operators.ranking import rank_within
from tallywright.session import shuffles_freed, stored

# fixed values: the columns of the marts and their order
_DAY_COUNTS = (
    "orders_placed", "orders", "cancelled_orders", "returned_orders", "new_customer_orders",
    "repeat_customer_orders", "customers", "units_sold",
)
_DAY_AMOUNTS = (
    "net_revenue", "net_cogs", "net_gross_profit", "returned_revenue", "discount_amount",
)


def daily_orders(orders: DataFrame) -> DataFrame:
    """One row per day that has orders."""
    return orders.groupBy(F.col("ordered_date").alias("revenue_date")).agg(
        F.count("*").alias("orders_placed"),
        F.count_if("is_revenue_recognised").alias("orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.count_if("is_returned").alias("returned_orders"),
        F.count_if("is_first_purchase").alias("new_customer_orders"),
        F.count_if("is_repeat_purchase").alias("repeat_customer_orders"),
        F.countDistinct("user_id").alias("customers"),
        F.sum("units_sold").alias("units_sold"),
        *(total(F.col(name)).alias(name) for name in _DAY_AMOUNTS),
        F.bool_or("is_revenue_complete").alias("any_complete"),
    )


def trailing_average(c: Column, day: str, preceding: int, digits: int) -> Column:
    """Average over this day and the ``preceding`` days before it."""
    frame = Window.orderBy(day).rowsBetween(-preceding, 0)
    return ratio(F.sum(c).over(frame), F.count(c).over(frame), digits)


def fct_daily_revenue(daily: DataFrame) -> DataFrame:
    """One row per calendar day, including days without orders.

    Everything after the daily aggregate works on one row per day, so the
    unpartitioned windows are bounded by the calendar.
    """
    d = F.col("revenue_date")
    last_complete = F.max(F.when(F.col("any_complete"), d)).over(Window.partitionBy())
    filled = fill_days(daily.withColumn("complete_through", last_complete), "revenue_date").withColumn(
        "complete_through", F.max("complete_through").over(Window.partitionBy())
    )
    revenue = F.coalesce(F.col("net_revenue"), F.lit(0)).cast("decimal(28,2)")
    return filled.select(
        "revenue_date",
        (d <= F.col("complete_through")).alias("is_revenue_complete"),
        week_of(d).alias("revenue_week"),
        truncate(d, "month").alias("revenue_month"),
        truncate(d, "quarter").alias("revenue_quarter"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
        *(F.coalesce(F.col(name), F.lit(0)).alias(name) for name in _DAY_COUNTS),
        *(F.coalesce(F.col(name), F.lit(0)).cast("decimal(28,2)").alias(name) for name in _DAY_AMOUNTS),
        ratio(F.col("net_revenue"), F.col("orders"), 2).alias("avg_order_value"),
        ratio(F.col("net_gross_profit"), F.col("net_revenue"), 4).alias("gross_margin_pct"),
        ratio(F.col("cancelled_orders"), F.col("orders_placed"), 4).alias("cancellation_rate"),
        ratio(F.col("returned_orders"), F.col("orders_placed"), 4).alias("return_rate"),
        trailing_average(revenue, "revenue_date", 6, 2).alias("net_revenue_7d_avg"),
        F.lag(revenue, SAME_WEEKDAY_LAST_YEAR_DAYS).over(Window.orderBy("revenue_date")).alias("net_revenue_ly"),
    )


def product_month(items: DataFrame) -> DataFrame:
    """One row per product and month of sale."""
    return items.groupBy(truncate(F.col("ordered_date"), "month").alias("revenue_month"), "product_id").agg(
        F.count("*").alias("line_items"),
        F.sum("net_units").alias("units_sold"),
        F.count_if("is_returned").alias("units_returned"),
        F.countDistinct("user_id").alias("customers"),
        *(
            total(F.col(name)).alias(name)
            for name in ("net_revenue", "net_cogs", "net_gross_profit", "discount_amount")
        ),
    )


PRODUCT_MONTH_COLUMNS = (
    "revenue_month", "product_id", "sku", "product_name", "brand", "category", "department", "price_tier",
    "distribution_center_name", "line_items", "units_sold", "units_returned", "customers", "net_revenue",
    "net_cogs", "net_gross_profit", "discount_amount",
)


def with_product(monthly: DataFrame, products: DataFrame) -> DataFrame:
    """Product months with catalogue columns."""
    catalogue = products.select(
        "product_id",
        "sku",
        "product_name",
        "brand",
        "category",
        "department",
        "price_tier",
        "distribution_center_name",
    )
    return monthly.join(catalogue, "product_id", "left").select(*PRODUCT_MONTH_COLUMNS)


def with_ratios(df: DataFrame) -> DataFrame:
    """Adds margin, return rate and selling price: ratios of the totals."""
    return df.select(
        "*",
        ratio(F.col("net_gross_profit"), F.col("net_revenue"), 4).alias("gross_margin_pct"),
        ratio(F.col("units_returned"), F.col("line_items"), 4).alias("return_rate"),
        ratio(F.col("net_revenue"), F.col("units_sold"), 2).alias("avg_selling_price"),
    )


def best_first() -> list[Column]:
    """Highest revenue first; the product id settles ties."""
    return [F.col("net_revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last()]


def with_share_of_month(df: DataFrame) -> DataFrame:
    """Adds each row's share of its month's revenue.

    Totals are aggregated and joined back (one row per calendar month), where a
    window would gather a whole month in one task.
    """
    totals = df.groupBy(F.col("revenue_month").alias("_month")).agg(total(F.col("net_revenue")).alias("_total"))
    return (
        df.join(F.broadcast(totals), F.col("revenue_month").eqNullSafe(F.col("_month")))
        .withColumn("pct_of_month_revenue", ratio(F.col("net_revenue"), F.col("_total"), 6))
        .drop("_month", "_total")
    )


def ranked_in_category(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Product months with their rank by revenue in month and category.

    Where no product is in the catalogue twice, month and product are a key, and whole rows are
    stored once with their rank. Else every row of a product month meets every rank of it.
    """
    groups, name = ["revenue_month", "category"], "revenue_rank_in_category"
    repeated = products.groupBy("product_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    with shuffles_freed(products.sparkSession):
        unique = repeated.isEmpty()
    if unique:
        return rank_within(rows, groups, best_first(), name)
    return rank_within(stored(rows, "product-months"), groups, best_first(), name, key=["revenue_month", "product_id"])


def product_ranks(items: DataFrame, products: DataFrame) -> DataFrame:
    """Month, product, category, revenue and rank: as in ``mart_product_performance``, without its other columns."""
    monthly = items.groupBy(truncate(F.col("ordered_date"), "month").alias("revenue_month"), "product_id").agg(
        total(F.col("net_revenue")).alias("net_revenue")
    )
    named = monthly.join(products.select("product_id", "category"), "product_id", "left")
    return ranked_in_category(named, products)


def mart_product_performance(named: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product and month, from the rows of ``with_product``: totals, ratios, rank in category, share of month.

    The ranked rows are stored, so that the months' totals do not take all items through their joins again.
    """
    ranked = ranked_in_category(named, products)
    return with_share_of_month(with_ratios(ranked)).select(
        *PRODUCT_MONTH_COLUMNS,
        "gross_margin_pct",
        "return_rate",
        "avg_selling_price",
        "revenue_rank_in_category",
        "pct_of_month_revenue",
    )
