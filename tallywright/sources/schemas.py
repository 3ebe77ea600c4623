"""Schemas of the seven source tables (only the columns the models read)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    fields = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS: dict[str, T.StructType] = {
    "users": _schema(
        "id bigint, first_name string, last_name string, email string, age bigint, gender string, "
        "city string, state string, postal_code string, country string, latitude double, "
        "longitude double, traffic_source string, created_at timestamp"
    ),
    "orders": _schema(
        "order_id bigint, user_id bigint, status string, num_of_item bigint, created_at timestamp, "
        "shipped_at timestamp, delivered_at timestamp, returned_at timestamp"
    ),
    "order_items": _schema(
        "id bigint, order_id bigint, user_id bigint, product_id bigint, inventory_item_id bigint, "
        "status string, sale_price double, created_at timestamp, shipped_at timestamp, "
        "delivered_at timestamp, returned_at timestamp"
    ),
    "products": _schema(
        "id bigint, distribution_center_id bigint, sku string, name string, brand string, "
        "category string, department string, retail_price double, cost double"
    ),
    "inventory_items": _schema(
        "id bigint, product_id bigint, product_distribution_center_id bigint, cost double, "
        "created_at timestamp, sold_at timestamp"
    ),
    "distribution_centers": _schema("id bigint, name string, latitude double, longitude double"),
    "events": _schema(
        "id bigint, user_id bigint, session_id string, sequence_number bigint, event_type string, "
        "traffic_source string, browser string, uri string, city string, state string, "
        "postal_code string, created_at timestamp"
    ),
}


def _same_kind(have: T.DataType, want: T.DataType) -> bool:
    if isinstance(want, T.TimestampType):
        return isinstance(have, (T.TimestampType, T.TimestampNTZType))
    if isinstance(want, T.LongType):
        return isinstance(have, T.IntegralType)
    return have == want


def conform(df: DataFrame, table: str) -> DataFrame:
    """Keep the declared columns; fail early when one is missing or mistyped."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name} {have.get(f.name, 'missing')} (want {f.dataType.simpleString()})"
        for f in SCHEMAS[table]
        if f.name not in have or not _same_kind(have[f.name], f.dataType)
    ]
    if wrong:
        raise TypeError(f"{table}: " + "; ".join(wrong))
    return df.select(*SCHEMAS[table].fieldNames())
