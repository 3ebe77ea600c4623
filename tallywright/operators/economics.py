"""Unit economics and their roll-up to orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.money import MONEY, cents, from_cents, ratio, total, zero
from tallywright.operators.joins import HotKeys, dealt, lookup

#: amounts that add up from units to orders, days and months
AMOUNTS = ("gross_revenue", "net_revenue", "net_cogs", "net_gross_profit", "returned_revenue", "discount_amount")


def join_inventory(items: DataFrame, inventory: DataFrame, hot: Sequence = ()) -> DataFrame:
    """Items with the landed cost of the very unit that shipped.

    Both sides are fact-sized. Items without a unit are dealt past the shuffle's
    key; ``hot`` units are split.
    """
    return lookup(items, inventory.select("inventory_item_id", "unit_cost"), "inventory_item_id", "order_item_id", hot)


def join_products(items: DataFrame, products: DataFrame, hot: Sequence = (), part: str | None = None) -> DataFrame:
    """Items with their catalogue attributes.

    No broadcast hint: the catalogue grows with the data, so Spark decides from
    its measured size. ``hot`` products, measured best sellers, are split.
    """
    catalogue = products.select(
        "product_id", "product_name", "brand", "category", "department", "distribution_center_id", "list_price", "list_cost"
    )
    return lookup(items, catalogue, "product_id", "order_item_id", hot, part=part)


def split_amounts() -> dict[str, Column]:
    """Gross, net, cost, returned and discount amounts of one unit."""
    price, recognised = F.col("sale_price"), F.col("is_revenue_recognised")
    landed_cost = F.coalesce(F.col("unit_cost"), F.col("list_cost"))
    return {
        "gross_revenue": price,
        "net_revenue": F.when(recognised, price).otherwise(zero()),
        "net_cogs": F.when(recognised, landed_cost).otherwise(zero()),
        "returned_revenue": F.when(F.col("is_returned"), price).otherwise(zero()),
        "discount_amount": (F.col("list_price") - price).cast(MONEY),
        "net_units": recognised.cast("bigint"),
    }


def with_margin(df: DataFrame) -> DataFrame:
    """Adds gross profit and its share of net revenue (null when that is 0)."""
    profit = (F.col("net_revenue") - F.col("net_cogs")).cast(MONEY)
    return df.withColumn("net_gross_profit", profit).withColumn(
        "net_margin_pct", ratio(F.col("net_gross_profit"), F.col("net_revenue"), 9)
    )


#: what the money of a unit is split from
_PRICES = ("sale_price", "unit_cost", "list_cost")


def enrich_items(items: DataFrame, inventory: DataFrame, products: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Unit grain: items with cost, catalogue attributes and money split.

    ``hot`` names the keys of each column that hold many of the rows (``joins.hot_keys``).
    """
    return split_items(join_items(items, inventory, products, hot))


def split_items(joined: DataFrame) -> DataFrame:
    """Rows of ``join_items`` with their money split in place of the prices; other columns stay."""
    kept = [c for c in joined.columns if c not in _PRICES]
    return with_margin(joined.select(*kept, *(amount.alias(name) for name, amount in split_amounts().items())))


def join_items(items: DataFrame, inventory: DataFrame, products: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Unit grain: items with cost and catalogue attributes, and nothing that follows from other columns of money."""
    hot = hot or {}
    items = dealt(items, "product_id", "order_item_id", hot.get("product_id", ()), part="_products_part")
    with_cost = join_inventory(items, inventory, hot.get("inventory_item_id", ()))
    joined = join_products(with_cost, products, hot.get("product_id", ()), "_products_part")
    return joined.select(
        "order_item_id",
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        "item_status",
        "is_revenue_recognised",
        "is_returned",
        "is_cancelled",
        "ordered_at",
        "ordered_date",
        "returned_at",
        "product_name",
        "brand",
        "category",
        "department",
        "distribution_center_id",
        "list_price",
        *_PRICES,
    )


#: order-grain sums of unit flags and counts, and the unit expression each adds up
_COUNTS = {
    "line_items": lambda: F.lit(1),
    "units_sold": lambda: F.col("net_units"),
    "returned_items": lambda: F.col("is_returned").cast("int"),
    "cancelled_items": lambda: F.col("is_cancelled").cast("int"),
}


def _units() -> dict[str, Column]:
    return {**{name: unit() for name, unit in _COUNTS.items()}, **{name: cents(F.col(name)) for name in AMOUNTS}}


def _order_sums() -> dict[str, Column]:
    """The order-grain columns, from the sums of ``_units`` under the same names."""
    return {
        "line_items": F.col("line_items"),
        "units_sold": F.col("units_sold"),
        **{name: from_cents(F.col(name)).cast(MONEY) for name in AMOUNTS},
        "returned_items": F.coalesce("returned_items", F.lit(0)),
        "cancelled_items": F.coalesce("cancelled_items", F.lit(0)),
    }


def sum_orders(items: DataFrame) -> DataFrame:
    """Order grain: the counts and sums of ``roll_up_orders``, combined before the one shuffle they need."""
    by_order = items.groupBy("order_id").agg(*(F.sum(unit).alias(name) for name, unit in _units().items()))
    return by_order.select("order_id", *(c.alias(name) for name, c in _order_sums().items()))


def roll_up_orders(items: DataFrame, hot: Sequence | None = None) -> DataFrame:
    """Order grain: counts, sums and variety of enriched items.

    ``hot`` names the orders that hold many of the rows, if they were measured (``joins.hot_keys``): the items of
    all others are dealt by order once, and no step of their chain shuffles again. Without it, for hot orders and
    for items without an order, every step of the chain combines before a shuffle of its own.
    """
    if hot is None:
        return _rolled_up(items)
    apart = F.col("order_id").isNull() | F.col("order_id").isin(*hot)
    return _rolled_up(items.where(~apart).repartition("order_id")).unionByName(_rolled_up(items.where(apart)))


def _rolled_up(items: DataFrame) -> DataFrame:
    """Counts, sums and variety of items by order, in one chain.

    (order, category, product), then (order, category), then order: each step
    carries the sums of the one before, and counts its groups, which are the
    distinct products and categories. Every step combines before its shuffle, so
    an order with very many lines is spread over its products first; the items
    are joined and read once, without an Expand and without collected sets.
    """
    units = _units()
    carried = [F.sum(name).alias(name) for name in units]
    by_product = items.groupBy("order_id", "category", "product_id").agg(
        *(F.sum(unit).alias(name) for name, unit in units.items()), F.max("gross_revenue").alias("top_unit")
    )
    by_category = by_product.groupBy("order_id", "category").agg(
        *carried, F.count("product_id").alias("distinct_products"), F.max("top_unit").alias("top_unit")
    )
    by_order = by_category.groupBy("order_id").agg(
        *carried,
        F.sum("distinct_products").alias("distinct_products"),
        F.count("category").alias("distinct_categories"),
        # ties go to the later name; a unit without category is nobody's dearest
        F.max(F.when(F.col("category").isNotNull(), F.struct("top_unit", "category"))).alias("dearest"),
    )
    sums = _order_sums()
    return by_order.select(
        "order_id",
        *(sums[name].alias(name) for name in ("line_items", "units_sold")),
        "distinct_products",
        "distinct_categories",
        *(sums[name].alias(name) for name in (*AMOUNTS, "returned_items", "cancelled_items")),
        F.col("dearest.category").alias("sample_category"),
    )


def revenue_by_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(total(F.col("net_revenue")).alias("net_revenue"))
