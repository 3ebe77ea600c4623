"""Cleaning the sources: names, types, flags, exact money, time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.functions.dates import day_diff
from tallywright.functions.money import money
from tallywright.functions.rules import age_band, status_flags
from tallywright.functions.text import blank_to_null, lower_email, title_case


def _clean(**renames: str) -> list[Column]:
    return [blank_to_null(F.col(source)).alias(name) for name, source in renames.items()]


def _flags(status: str, cfg: Config) -> list[Column]:
    return [flag.alias(name) for name, flag in status_flags(F.col(status), cfg.revenue_statuses).items()]


def within_window(df: DataFrame, cfg: Config, column: str = "created_at") -> DataFrame:
    """Rows from the analysis start up to the clamp time.

    Both bounds take the column's own type, so the scan can apply them.
    """
    kind = df.schema[column].dataType
    upper = F.current_timestamp() if cfg.clamp_ts is None else F.lit(cfg.clamp_ts.isoformat(sep=" "))
    return df.where(F.col(column).between(F.lit(cfg.analysis_start.isoformat()).cast(kind), upper.cast(kind)))


def stage_users(users: DataFrame, cfg: Config) -> DataFrame:
    return within_window(users, cfg).select(
        F.col("id").alias("user_id"),
        title_case(F.col("first_name")).alias("first_name"),
        title_case(F.col("last_name")).alias("last_name"),
        lower_email(F.col("email")).alias("email"),
        F.col("age").cast("bigint").alias("age"),
        age_band(F.col("age")).alias("age_band"),
        *_clean(gender="gender", city="city", state="state", postal_code="postal_code", country="country"),
        "latitude",
        "longitude",
        *_clean(traffic_source="traffic_source"),
        F.col("created_at").alias("registered_at"),
        F.to_date("created_at").alias("registered_date"),
    )


def stage_orders(orders: DataFrame, cfg: Config) -> DataFrame:
    created, shipped, delivered = F.col("created_at"), F.col("shipped_at"), F.col("delivered_at")
    return within_window(orders, cfg).select(
        "order_id",
        "user_id",
        F.col("status").alias("order_status"),
        *_flags("status", cfg),
        F.col("num_of_item").cast("bigint").alias("items_ordered"),
        created.alias("ordered_at"),
        F.to_date(created).alias("ordered_date"),
        F.trunc(F.to_date(created), "month").alias("ordered_month"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        day_diff(shipped, created).alias("days_to_ship"),
        day_diff(delivered, shipped).alias("days_in_transit"),
        day_diff(delivered, created).alias("days_to_deliver"),
    )


def stage_order_items(items: DataFrame, cfg: Config) -> DataFrame:
    return within_window(items, cfg).select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        F.col("status").alias("item_status"),
        *_flags("status", cfg),
        money(F.col("sale_price")).alias("sale_price"),
        F.col("created_at").alias("ordered_at"),
        F.to_date("created_at").alias("ordered_date"),
        "shipped_at",
        "delivered_at",
        "returned_at",
    )


def stage_products(products: DataFrame) -> DataFrame:
    retail, cost = F.col("retail_price"), F.col("cost")
    return products.select(
        F.col("id").alias("product_id"),
        "distribution_center_id",
        *_clean(sku="sku", product_name="name", brand="brand", category="category", department="department"),
        money(retail).alias("list_price"),
        money(cost).alias("list_cost"),
        money(retail - cost).alias("list_margin_amount"),
        F.try_divide(retail - cost, retail).alias("list_margin_pct"),
    )


def stage_inventory_items(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        F.col("id").alias("inventory_item_id"),
        "product_id",
        F.col("product_distribution_center_id").alias("distribution_center_id"),
        money(F.col("cost")).alias("unit_cost"),
        F.col("created_at").alias("stocked_at"),
        "sold_at",
        F.col("sold_at").isNotNull().alias("is_sold"),
        day_diff(F.col("sold_at"), F.col("created_at")).alias("days_on_shelf"),
    )


def stage_distribution_centers(centers: DataFrame) -> DataFrame:
    return centers.select(
        F.col("id").alias("distribution_center_id"),
        *_clean(distribution_center_name="name"),
        "latitude",
        "longitude",
    )


def stage_events(events: DataFrame, cfg: Config) -> DataFrame:
    return within_window(events, cfg).select(
        F.col("id").alias("event_id"),
        "user_id",
        "session_id",
        F.col("sequence_number").cast("bigint").alias("sequence_number"),
        *_clean(
            event_type="event_type",
            traffic_source="traffic_source",
            browser="browser",
            page_uri="uri",
            city="city",
            state="state",
            postal_code="postal_code",
        ),
        F.col("created_at").alias("occurred_at"),
        F.to_date("created_at").alias("occurred_date"),
    )
