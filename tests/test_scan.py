"""Prefix sums and order numbers against windows, with groups over many partitions."""

from datetime import datetime

import frames
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.operators.history import order_sequence
from tallywright.operators.scan import prefix_sums
from tallywright.operators.staging import stage_orders


@pytest.fixture
def eager(spark):
    """Range partitions of a few rows each."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("groups", [["g"], ["g", "h"], []])
def test_prefix_sums_equal_windows(spark, eager, groups):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 != 0, 1).when(F.col("id") % 5 != 0, None).otherwise(F.col("id") % 4).alias("g"),
        F.when(F.col("id") % 2 == 0, "x").alias("h"), ((F.col("id") * 7919) % 101).alias("t"))
    order = [F.col("t").desc(), F.col("id")]
    value = F.when(F.col("id") % 7 != 0, F.col("id"))
    got = prefix_sums(df, groups, order, {"n": F.lit(1), "s": value}, {"low": F.min("t"), "high": F.max(value)})
    running = W.partitionBy(*groups).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*groups)
    plain = df.select(
        "*", F.count("*").over(running).alias("n"), F.coalesce(F.sum(value).over(running), F.lit(0)).alias("s"),
        F.min("t").over(whole).alias("low"), F.max(value).over(whole).alias("high"))
    assert _same(got, plain)


def test_only_min_and_max_cover_the_group(spark):
    with pytest.raises(ValueError, match="min and max"):
        prefix_sums(spark.range(3), [], ["id"], {}, {"a": F.avg("id")})


def test_a_third_of_the_orders_without_customer_on_one_day(spark, eager, cfg):
    """All at the same instant, so only the order id tells them apart; a customer with the least id of all
    is not mixed up with them."""
    day, least = datetime(2021, 5, 1), -(2**63)
    rows = [{"order_id": i, "user_id": None, "created_at": day, "status": "Complete" if i % 3 else "Cancelled"} for i in range(400)]
    rows += [{"order_id": 400 + i, "user_id": least, "created_at": day} for i in range(10)]
    rows += [{"order_id": 1000 + i, "user_id": i % 50, "created_at": datetime(2021, 1 + i % 12, 1 + i % 20)} for i in range(800)]
    orders = stage_orders(frames.orders(spark, *rows), cfg)
    bought = F.col("is_revenue_recognised")
    running = W.partitionBy("user_id").orderBy("ordered_at", "order_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("user_id")
    at = F.when(bought, F.col("ordered_at"))
    plain = orders.select(
        "order_id", F.count("*").over(running).alias("order_seq"), F.when(bought, F.count_if(bought).over(running)).alias("purchase_seq"),
        F.min(at).over(whole).alias("first_purchase_at"), F.max(at).over(whole).alias("latest_purchase_at"))
    got = order_sequence(orders)
    assert _same(got, plain) and got.count() == 1210
    assert got.where("order_id between 400 and 409").agg(F.max("order_seq")).first()[0] == 10
