"""Small hand-made source frames."""

from datetime import datetime

from tallywright.sources.schemas import SCHEMAS


def ts(text):
    return datetime.fromisoformat(text) if text else None


def source(spark, table, rows):
    """Rows as dicts; columns left out are null."""
    schema = SCHEMAS[table]
    full = [tuple(row.get(name) for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(full, schema)


def users(spark, *rows):
    base = {"first_name": "a", "last_name": "b", "email": "x@y", "age": 30, "gender": "F", "created_at": ts("2020-01-02")}
    return source(spark, "users", [base | row for row in rows])


def orders(spark, *rows):
    base = {"status": "Complete", "num_of_item": 1}
    return source(spark, "orders", [base | row for row in rows])


def items(spark, *rows):
    base = {"status": "Complete", "product_id": 1, "sale_price": 10.0}
    return source(spark, "order_items", [base | row for row in rows])


def products(spark, *rows):
    base = {"sku": "s", "name": "n", "brand": "b", "category": "c", "department": "Men", "retail_price": 20.0, "cost": 8.0}
    return source(spark, "products", [base | row for row in rows])


def inventory(spark, *rows):
    return source(spark, "inventory_items", list(rows))


def shop(spark, cfg, order_rows, item_rows, user_rows=({"id": 1},), product_rows=({"id": 1},), inventory_rows=()):
    from tallywright.plans.warehouse import Warehouse

    return Warehouse(
        {
            "users": users(spark, *user_rows),
            "orders": orders(spark, *order_rows),
            "order_items": items(spark, *item_rows),
            "products": products(spark, *product_rows),
            "inventory_items": inventory(spark, *inventory_rows),
            "distribution_centers": source(spark, "distribution_centers", [{"id": 1, "name": "x"}]),
            "events": source(spark, "events", []),
        },
        cfg,
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
