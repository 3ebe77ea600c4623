"""The bundled test tables, expressed as the seven source tables.

The test data has a generic order/line layout. Every row of every source below is
derived from it with map-only expressions and key joins, so the mapping scales
like the tables do.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: orders without lines are placed on the three days from here on: their items have not landed yet
ITEMS_MISSING_FROM = datetime(2001, 7, 30)
#: added to the id of an inventory unit that no item shall find; ids of lines have 60 bits
UNMATCHED = 1 << 60
CENTERS = 25


def _days_after(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"))


def _status(code: Column, key: Column) -> Column:
    return (
        F.when(code == "F", F.when(key % 4 == 0, "Returned").otherwise("Complete"))
        .when(code == "O", F.when(key % 4 == 1, "Cancelled").otherwise("Shipped"))
        .when(code == "P", F.when(key % 4 == 2, "Cancelled").otherwise("Processing"))
    )


def _retail_cents(part_key: Column) -> Column:
    return 1099 + (part_key * 700) % 29000


def _line_id() -> Column:
    """60 bits of the digest of the line's key; two engines compute it alike."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    text = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day, cents)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _milestones(status: Column, order_id: Column, created: Column) -> dict[str, Column]:
    shipped = F.when(
        status.isin("Shipped", "Complete", "Returned"), _days_after(created, 1 + order_id % 3)
    )
    delivered = F.when(
        status.isin("Complete", "Returned"), _days_after(created, 3 + order_id % 3 + order_id % 4)
    )
    returned = F.when(
        status == "Returned", _days_after(created, 8 + order_id % 3 + order_id % 4)
    )
    return {"shipped_at": shipped, "delivered_at": delivered, "returned_at": returned}


def _users(t: dict[str, DataFrame]) -> DataFrame:
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("first_name"),
        F.lit("SMITH").alias("last_name"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM")).alias("email"),
        (18 + F.col("c_custkey") % 60).alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(F.col("c_custkey") % 11 == 0, "  ")
        .otherwise((10000 + F.col("c_custkey")).cast("string"))
        .alias("postal_code"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (2 * F.col("n_nationkey")).cast("double").alias("longitude"),
        F.col("c_mktsegment").alias("traffic_source"),
        _days_after(F.lit("1994-01-01").cast("timestamp_ntz"), F.col("c_custkey") % 360).alias("created_at"),
    )
    browsers = t["supplier"].join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (1000000 + F.col("s_suppkey")).alias("id"),
        F.concat(F.lit(" "), F.lower("s_name")).alias("first_name"),
        F.lit("SMITH").alias("last_name"),
        F.concat("s_name", F.lit("@EXAMPLE.COM")).alias("email"),
        (18 + F.col("s_suppkey") % 60).alias("age"),
        F.lit("F").alias("gender"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit("").alias("postal_code"),
        F.col("n_name").alias("country"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("BUILDING").alias("traffic_source"),
        _days_after(F.lit("1994-06-01").cast("timestamp_ntz"), F.col("s_suppkey") % 200).alias("created_at"),
    )
    return buyers.unionByName(browsers)


def _orders(t: dict[str, DataFrame]) -> DataFrame:
    lines = t["lineitem"].groupBy("l_orderkey").agg(F.count("*").alias("num_of_item"))
    heads = t["orders"].select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _status(F.col("o_orderstatus"), F.col("o_orderkey")).alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )
    late = _days_after(F.lit(ITEMS_MISSING_FROM).cast("timestamp_ntz"), F.col("order_id") % 3)
    placed = heads.join(lines, heads.order_id == lines.l_orderkey, "left").withColumns({
        "created_at": F.when(F.col("num_of_item").isNull(), late).otherwise(F.col("created_at")),
        "num_of_item": F.coalesce("num_of_item", F.lit(1)),
    })
    return placed.select(
        "order_id",
        "user_id",
        "status",
        "num_of_item",
        "created_at",
        *(c.alias(n) for n, c in _milestones(F.col("status"), F.col("order_id"), F.col("created_at")).items()),
    )


def _order_items(t: dict[str, DataFrame]) -> DataFrame:
    lines = t["lineitem"].select(
        _line_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        _retail_cents(F.col("l_partkey")).alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("off"),
    )
    heads = (
        t["orders"]
        .select(
            "o_orderkey",
            F.col("o_custkey").alias("user_id"),
            _status(F.col("o_orderstatus"), F.col("o_orderkey")).alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )
    )
    discount = F.floor(F.col("cents") * F.col("off") / 100.0)
    return lines.join(heads, lines.order_id == heads.o_orderkey).select(
        "id",
        "order_id",
        "user_id",
        "product_id",
        F.col("id").alias("inventory_item_id"),
        "status",
        ((F.col("cents") - discount) / 100.0).alias("sale_price"),
        "created_at",
        *(c.alias(n) for n, c in _milestones(F.col("status"), F.col("order_id"), F.col("created_at")).items()),
    )


def _inventory_items(t: dict[str, DataFrame]) -> DataFrame:
    cents = _retail_cents(F.col("l_partkey"))
    unmatched = (F.col("l_linenumber") == 7) & (F.col("l_orderkey") % 50 == 0)
    sold = (
        t["lineitem"]
        .select(
            F.when(unmatched, _line_id() + UNMATCHED).otherwise(_line_id()).alias("id"),
            F.col("l_partkey").alias("product_id"),
            (F.col("l_partkey") % CENTERS).alias("product_distribution_center_id"),
            (F.floor(cents * (40 + F.col("l_suppkey") % 20) / 100.0) / 100.0).alias("cost"),
            _days_after(F.col("l_shipdate"), -(10 + F.col("l_linenumber"))).alias("created_at"),
            F.col("l_shipdate").alias("sold_at"),
        )
    )
    unsold = t["part"].select(
        (1000000000000 + F.col("p_partkey")).alias("id"),
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") % CENTERS).alias("product_distribution_center_id"),
        (F.floor(_retail_cents(F.col("p_partkey")) * 0.5) / 100.0).alias("cost"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("sold_at"),
    )
    return sold.unionByName(unsold)


def _products(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("p_partkey")
    return t["part"].select(
        key.alias("id"),
        (key % CENTERS).alias("distribution_center_id"),
        F.concat(F.lit("SKU"), key.cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.when(key % 2 == 0, "Men").otherwise("Women").alias("department"),
        (_retail_cents(key) / 100.0).alias("retail_price"),
        (F.floor(_retail_cents(key) * 0.5) / 100.0).alias("cost"),
    )


def _centers(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        (2 * F.col("n_nationkey")).cast("double").alias("longitude"),
    )


def _events(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("event_id")
    return t["events"].select(
        key.alias("id"),
        "user_id",
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        (key % 10 + 1).alias("sequence_number"),
        "event_type",
        F.when(key % 3 == 0, "Search").when(key % 3 == 1, "Email").otherwise("").alias("traffic_source"),
        F.lit("Chrome").alias("browser"),
        F.concat(F.lit("/"), "event_type").alias("uri"),
        F.lit("").alias("city"),
        F.lit("").alias("state"),
        F.lit("").alias("postal_code"),
        F.col("ts").alias("created_at"),
    )


_RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parquet")
        for name, schema in _RAW.items()
    }


def sample_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    raw = raw_tables(spark, folder)
    return {
        "users": _users(raw),
        "orders": _orders(raw),
        "order_items": _order_items(raw),
        "products": _products(raw),
        "inventory_items": _inventory_items(raw),
        "distribution_centers": _centers(raw),
        "events": _events(raw),
    }


def raw_orders_and_items(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders and items as they are, headers without lines included.

    About two in a hundred old orders have no lines here, which is what the
    completeness check must notice.
    """
    raw = raw_tables(spark, folder)
    orders = raw["orders"].select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _status(F.col("o_orderstatus"), F.col("o_orderkey")).alias("status"),
        F.lit(1).cast("bigint").alias("num_of_item"),
        F.col("o_orderdate").alias("created_at"),
        *(F.lit(None).cast("timestamp_ntz").alias(c) for c in ("shipped_at", "delivered_at", "returned_at")),
    )
    return {"orders": orders, "items": raw["lineitem"].select(F.col("l_orderkey").alias("order_id"))}
