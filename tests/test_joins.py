"""Lookups with hot and null keys, with adaptive execution off."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallywright.catalog.queries import Sample
from tallywright.operators import economics
from tallywright.operators.joins import hot_keys, lookup


@pytest.fixture
def plain_execution(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows(spark):
    """A third of the rows have no key, a third key 7."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))
    return spark.range(6000).select(F.col("id").alias("row"), key.alias("key"))


def _largest_share(joined):
    return joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]


def test_hot_and_null_keys_spread_over_the_tasks(spark, plain_execution):
    rows = _rows(spark)
    table = spark.range(0, 6000, 2).union(spark.createDataFrame([(7,)], "id long")).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
    hot = hot_keys(rows, "key")["key"]
    assert hot == [7]
    joined = lookup(rows, table, "key", "row", hot)
    plain = rows.join(table, "key", "left")
    assert joined.columns == ["key", "row", "value"]
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    # a task holds little more than a sixteenth; the plain join has a third or more in one
    assert _largest_share(joined.where("value is null or value >= 0")) < 6000 / 8 < 2000 <= _largest_share(plain)


def test_lookups_read_only_what_is_asked_for(spark):
    sample = Sample(spark, SMALL)
    text = economics.join_inventory(sample.order_items, sample.inventory_items).select("unit_cost")
    assert "l_comment" not in text._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 50])
def test_few_rows_have_hot_keys_only_when_repeated(spark, n):
    rows = spark.range(n).select(F.col("id").alias("a"), F.lit(None).cast("long").alias("b"))
    assert hot_keys(rows, "a", "b") == {"a": [], "b": []}


def test_hot_keys_are_whole_numbers(spark):
    with pytest.raises(TypeError):
        hot_keys(spark.range(3).select(F.col("id").cast("string").alias("key")), "key")


def test_the_same_mart_with_measured_keys(spark, plain_execution):
    sample = Sample(spark, SMALL)
    items = sample.order_items.withColumn("product_id", F.when(F.col("order_id") % 3 == 0, 4).when(F.col("order_id") % 3 == 1, None).otherwise(F.col("product_id")))
    hot = hot_keys(items, "inventory_item_id", "product_id")
    assert 4 in hot["product_id"] and not hot["inventory_item_id"]
    split = economics.enrich_items(items, sample.inventory_items, sample.products, hot)
    whole = economics.enrich_items(items, sample.inventory_items, sample.products)
    assert split.columns == whole.columns
    assert split.exceptAll(whole).count() == 0 and whole.exceptAll(split).count() == 0


@pytest.mark.parametrize("hot", [[], [1], [1, 2, 3]])
def test_orders_roll_up_alike_with_measured_hot_keys(spark, hot):
    rows = [(order, f"c{i % 3}" if i % 5 else None, i % 4, i) for order in (1, 2, 3, None) for i in range(40 if order == 1 else 7)]
    money = {name: "id" for name in economics.AMOUNTS}
    items = spark.createDataFrame(rows, "order_id bigint, category string, product_id bigint, id bigint").select(
        "order_id", "category", "product_id", *(F.col(c).cast("decimal(18,2)").alias(name) for name, c in money.items()),
        (F.col("id") % 2).alias("net_units"), (F.col("id") % 3 == 0).alias("is_returned"), (F.col("id") % 7 == 0).alias("is_cancelled"))
    chain, dealt = economics.roll_up_orders(items), economics.roll_up_orders(items, hot)
    assert dealt.columns == chain.columns and dealt.count() == 4
    assert dealt.exceptAll(chain).count() == 0 and chain.exceptAll(dealt).count() == 0


def test_usual_orders_are_dealt_once(spark):
    spread = {"order_id": "id", "category": "string(id % 2)", "product_id": "id % 3", "net_units": "id", "is_returned": "id = 1", "is_cancelled": "id = 2"}
    ids = spark.createDataFrame([(i,) for i in range(9)], "id bigint")
    items = ids.selectExpr(*(f"{value} {name}" for name, value in spread.items()), *(f"cast(id as decimal(18,2)) {c}" for c in economics.AMOUNTS))

    def shuffles(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_id")

    assert shuffles(economics.roll_up_orders(items)) == 3
    assert shuffles(economics.roll_up_orders(items, [3])) == 1 + 3  # all but the hot orders go by their order at once
