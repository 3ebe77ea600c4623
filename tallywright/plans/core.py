"""Order, unit, customer and product marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.functions.dates import day_diff
from tallywright.functions.money import MONEY, ratio, total, zero
from tallywright.functions.rules import customer_status, price_tier
from tallywright.operators.completeness import with_one_row
from tallywright.operators.history import join_economics, sequence_orders

# fixed values: the columns of the marts and their order
ORDER_COLUMNS = (
    "order_id", "user_id", "order_status", "is_revenue_recognised", "is_cancelled", "is_returned", "order_seq",
    "purchase_seq", "is_first_purchase", "is_repeat_purchase", "cohort_month", "months_since_first_purchase",
    "has_line_items", "is_revenue_complete", "items_ordered", "line_items", "units_sold", "distinct_products",
    "distinct_categories", "gross_revenue", "net_revenue", "net_cogs", "net_gross_profit", "net_margin_pct",
    "returned_revenue", "discount_amount", "returned_items", "cancelled_items", "days_to_ship",
    "days_in_transit", "days_to_deliver", "ordered_at", "ordered_date", "ordered_month", "shipped_at",
    "delivered_at", "returned_at",
)

ITEM_COLUMNS = (
    "order_item_id", "order_id", "user_id", "product_id", "inventory_item_id", "distribution_center_id",
    "item_status", "is_revenue_recognised", "is_returned", "is_cancelled", "product_name", "brand", "category",
    "department", "list_price", "gross_revenue", "net_revenue", "net_cogs", "net_gross_profit",
    "net_margin_pct", "returned_revenue", "discount_amount", "net_units", "ordered_at", "ordered_date",
    "returned_at",
)


#: what takes the long chain of the order roll-up
VARIETY_COLUMNS = ("distinct_products", "distinct_categories")


def fct_orders(orders: DataFrame, rollup: DataFrame, boundary: DataFrame) -> DataFrame:
    """One row per order: sequence and cohort, completeness, economics.

    Sequence and economics are both narrow frames joined on order_id, so the wide
    rows are shuffled once. From ``economics.sum_orders`` the rows come without
    ``VARIETY_COLUMNS``.
    """
    joined = with_one_row(join_economics(sequence_orders(orders), rollup), boundary)
    return (
        joined.withColumn("has_line_items", F.col("line_items").isNotNull())
        .withColumn("is_revenue_complete", F.col("ordered_date") <= F.col("complete_through"))
        .withColumn("net_margin_pct", ratio(F.col("net_gross_profit"), F.col("net_revenue"), 9))
        .select(*(c for c in ORDER_COLUMNS if c in rollup.columns or c not in VARIETY_COLUMNS))
    )


def fct_order_items(enriched: DataFrame) -> DataFrame:
    """One row per unit sold."""
    return enriched.select(*ITEM_COLUMNS)


def customer_orders(orders: DataFrame) -> DataFrame:
    """One row per ordering customer: counts, recognised totals, first and last purchase."""
    bought = F.col("is_revenue_recognised")

    def recognised(name: str):
        return F.when(bought, F.col(name))

    return orders.groupBy("user_id").agg(
        F.count("*").alias("lifetime_orders_placed"),
        F.count_if(bought).alias("lifetime_orders"),
        F.count_if("is_cancelled").alias("lifetime_cancelled_orders"),
        F.count_if("is_returned").alias("lifetime_returned_orders"),
        total(recognised("net_revenue")).alias("lifetime_net_revenue"),
        total(recognised("net_gross_profit")).alias("lifetime_gross_profit"),
        F.sum(recognised("units_sold")).alias("lifetime_units"),
        # late (may still grow) and missing (unknown) are different things
        F.count_if(bought & ~F.col("is_revenue_complete")).alias("lifetime_incomplete_orders"),
        F.count_if(bought & ~F.col("has_line_items")).alias("lifetime_orders_missing_economics"),
        F.min(recognised("ordered_date")).alias("first_order_date"),
        F.max(recognised("ordered_date")).alias("latest_order_date"),
        # constant per customer
        F.max("cohort_month").alias("cohort_month"),
    )


def dim_customers(users: DataFrame, totals: DataFrame, as_of: DataFrame, cfg: Config) -> DataFrame:
    """One row per registered customer: lifetime value, recency, segment."""

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    def money_or_zero(name: str):
        return F.coalesce(F.col(name), zero()).alias(name)

    orders = F.coalesce(F.col("lifetime_orders"), F.lit(0))
    incomplete = F.coalesce(F.col("lifetime_incomplete_orders"), F.lit(0))
    idle = day_diff(F.col("as_of_date"), F.col("latest_order_date"))
    return with_one_row(users.join(totals, "user_id", "left"), as_of).select(
        "user_id",
        "first_name",
        "last_name",
        "email",
        "age",
        "age_band",
        "gender",
        "city",
        "state",
        "postal_code",
        "country",
        "traffic_source",
        "registered_date",
        "cohort_month",
        or_zero("lifetime_orders"),
        or_zero("lifetime_orders_placed"),
        or_zero("lifetime_cancelled_orders"),
        or_zero("lifetime_returned_orders"),
        or_zero("lifetime_units"),
        money_or_zero("lifetime_net_revenue"),
        money_or_zero("lifetime_gross_profit"),
        # null, not 0, while no recognised order has economics
        ratio(F.col("lifetime_net_revenue"), F.col("lifetime_orders"), 2).alias("avg_order_value"),
        or_zero("lifetime_incomplete_orders"),
        (incomplete > 0).alias("has_incomplete_orders"),
        or_zero("lifetime_orders_missing_economics"),
        "first_order_date",
        "latest_order_date",
        idle.alias("days_since_last_order"),
        day_diff(F.col("latest_order_date"), F.col("first_order_date")).alias("customer_tenure_days"),
        (orders > 0).alias("has_purchased"),
        (orders > 1).alias("is_repeat_customer"),
        (idle <= cfg.active_window_days).alias("is_active"),
        customer_status(F.col("lifetime_orders"), idle, cfg.active_window_days, cfg.lapsing_days).alias(
            "customer_status"
        ),
        "as_of_date",
    )


def inventory_by_product(inventory: DataFrame) -> DataFrame:
    """One row per stocked product: units, landed cost, shelf time of sold units."""
    return (
        inventory.groupBy("product_id")
        .agg(
            F.count("*").alias("units_stocked"),
            F.count_if("is_sold").alias("units_sold_all_time"),
            total(F.col("unit_cost")).alias("_cost"),
            F.count("unit_cost").alias("_costed"),
            F.sum(F.when(F.col("is_sold"), F.col("days_on_shelf"))).alias("_days"),
            F.count(F.when(F.col("is_sold"), F.col("days_on_shelf"))).alias("_shelved"),
        )
        .select(
            "product_id",
            "units_stocked",
            "units_sold_all_time",
            ratio(F.col("_cost"), F.col("_costed"), 2).cast(MONEY).alias("avg_unit_cost"),
            ratio(F.col("_days"), F.col("_shelved"), 1).alias("avg_days_on_shelf"),
        )
    )


def dim_products(products: DataFrame, centers: DataFrame, stock: DataFrame) -> DataFrame:
    """One row per SKU with its center, stock figures and price tier."""
    names = centers.select("distribution_center_id", "distribution_center_name")
    return (
        products.join(names, "distribution_center_id", "left")
        .join(stock, "product_id", "left")
        .select(
            "product_id",
            "sku",
            "product_name",
            "brand",
            "category",
            "department",
            "distribution_center_id",
            "distribution_center_name",
            "list_price",
            "list_cost",
            "list_margin_amount",
            "list_margin_pct",
            "avg_unit_cost",
            "units_stocked",
            "units_sold_all_time",
            "avg_days_on_shelf",
            ratio(F.col("units_sold_all_time"), F.col("units_stocked"), 4).alias("sell_through_rate"),
            price_tier(F.col("list_price")).alias("price_tier"),
        )
    )
