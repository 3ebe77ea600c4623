"""Results stay equal to SQL when one key holds a third of all rows, with every
join forced through shuffles and skew handling switched to its most eager."""

import duckdb
import pytest
from compare import TABLES, connect, difference
from conftest import SMALL

NAMES = [
    "fct_orders", "fct_order_items", "dim_customers", "dim_products", "fct_daily_revenue", "mart_product_performance",
    "mart_customer_cohorts", "mart_acquisition_channels", "revenue_concentration", "topk_products", "win_ntile10",
    "win_order_seq", "chk_relationships", "mq_two_hop", "mq_entity_join", "join_reconcile",
]

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of the orders belong to one customer; a third of the lines to one
    order and to one product."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changes = {
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey)",
        "lineitem": "* REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 9 ELSE l_orderkey END AS l_orderkey, "
        "CASE WHEN l_orderkey % 3 = 1 THEN 4 ELSE l_partkey END AS l_partkey)",
    }
    for table in TABLES:
        con.execute(
            f"COPY (SELECT {changes.get(table, '*')} FROM '{SMALL}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)"
        )
    return str(folder)


@pytest.fixture(scope="module")
def eager(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_data_equals_sql(name, spark, eager, skewed):
    assert difference(name, spark, connect(skewed), skewed) is None
