"""The physical plans hold the properties the design relies on."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallywright.catalog.queries import QUERIES, Sample
from tallywright.operators import ranking
from tallywright.plans import contracts, metrics

FACT_SCALE = [
    "fct_orders", "fct_order_items", "dim_customers", "orders_aggregated", "customer_orders", "product_month",
    "inventory_by_product", "int_customer_order_history", "win_purchase_seq", "join_reconcile", "cohort_activity",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", FACT_SCALE)
def test_no_single_partition_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](Sample(spark, SMALL)))
    assert "Python" not in text and "CartesianProduct" not in text
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            # only the merge of a global aggregate's partial results
            assert "HashAggregate(keys=[]" in lines[i + 1], line
        assert "BroadcastNestedLoopJoin" not in line


def test_nothing_is_broadcast_without_a_size(spark, no_broadcast):
    assert "BroadcastExchange" not in plan(QUERIES["dim_customers"](Sample(spark, SMALL)))


def test_unread_boundary_costs_nothing(spark):
    text = plan(QUERIES["met_net_revenue"](Sample(spark, SMALL)))
    assert "first_incomplete_date" not in text and "LeftAnti" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(Sample(spark, SMALL).order_items.select("order_item_id"))
    assert "GreaterThanOrEqual(o_orderdate,1994-01-01T00:00)" in text
    events = plan(Sample(spark, SMALL).events.select("event_id"))
    assert "LessThanOrEqual(ts,2024-12-31T00:00)" in events
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in events


def test_roll_up_has_no_expand(spark):
    assert "Expand" not in plan(QUERIES["orders_aggregated"](Sample(spark, SMALL)))


def test_windows_never_span_a_customer(spark):
    text = plan(QUERIES["win_order_seq"](Sample(spark, SMALL)))
    fact_windows = [line for line in text.splitlines() if "Window [" in line and "order_id" in line]
    windows = [line for line in text.splitlines() if "Window [" in line]
    # rows: within one partition of the range sort; carry-over: one row per customer and partition
    assert windows and all("_part" in line for line in windows) and not fact_windows


def executed(text, node):
    return len([line for line in text.splitlines() if node in line and "Reused" not in line])


@pytest.mark.parametrize("name", ["orders_aggregated", "agg_any_value"])
def test_roll_up_joins_units_and_products_once(spark, no_broadcast, name):
    text = plan(QUERIES[name](Sample(spark, SMALL)))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len([j for j in joins if "[inventory_item_id" in j]) <= 1
    assert len([j for j in joins if "[product_id" in j]) == 1


def test_order_mart_joins_units_and_products_once(spark, no_broadcast):
    joins = [line for line in plan(QUERIES["fct_orders"](Sample(spark, SMALL))).splitlines() if "Join" in line]
    assert len([j for j in joins if "[inventory_item_id" in j]) == 1
    assert len([j for j in joins if "[product_id" in j]) == 1


def test_top_k_sorts_no_range_and_has_one_plan_for_every_k(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("g"))

    def shape(k):
        text = plan(ranking.top_within(df, ["g"], [F.col("id").desc()], k, "r"))
        assert "rangepartitioning" not in text.lower()
        return [line.lstrip(" +-:").split(" ")[0] for line in text.splitlines()]

    assert shape(3) == shape(2000)


def test_all_grains_come_from_one_fact_aggregate(spark, no_broadcast):
    """As many joins and scans as a query of one grain."""
    sample = Sample(spark, SMALL)
    every = plan(QUERIES["mq_time_grain"](sample))
    one = plan(metrics.metric_query(sample.frame, ["net_revenue", "order_count"], ["metric_time"], grain="day"))
    for node in ("SortMergeJoin", "FileScan"):
        assert executed(every, node) == executed(one, node), node


@pytest.mark.parametrize("name, steps", [("mq_entity_join", 1), ("mq_two_hop", 2)])
def test_facts_are_aggregated_before_they_meet_a_dimension(spark, no_broadcast, name, steps):
    text = plan(QUERIES[name](Sample(spark, SMALL)))
    lines = text.splitlines()
    # the joins of the query are the topmost ones; each has an aggregate as its left input
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line and "__key" in line]
    assert len(joins) == steps
    for i in joins:
        below = [line for line in lines[i + 1 : i + 8] if "Aggregate" in line]
        assert below and "__key" in below[0], lines[i : i + 8]


def test_references_share_one_shuffle(spark, no_broadcast):
    tables = {
        "a": spark.range(100).selectExpr("id", "id % 7 as b_id", "id % 5 as c_id"), "b": spark.range(6).toDF("id"), "c": spark.range(5).toDF("id"),
    }
    refers = [contracts.Contract("relationships", "a", (c,), parent=p, parent_key="id") for c, p in (("b_id", "b"), ("c_id", "c"), ("id", "b"))]
    lost = contracts.lost_references(tables.get, refers)
    text = plan(lost)
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    got = sorted(map(tuple, lost.collect()))
    assert got == [("a", "b_id", 6, 14)] + [("a", "id", i, 1) for i in range(6, 100)]


def logical(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_product_months_are_built_once(spark, no_broadcast):
    """Ranks, totals and rows of the mart come from stored product months."""
    text = logical(QUERIES["mart_product_performance"](Sample(spark, SMALL)))
    assert "l_partkey" not in text and "inventory_item_id" not in text


def test_ranks_in_category_carry_nothing_else(spark, monkeypatch):
    from tallywright.operators import scan

    kept, stored = [], scan.stored
    monkeypatch.setattr(scan, "stored", lambda df, label: (kept.append((label, set(df.columns))), stored(df, label))[1])
    QUERIES["win_rank_in_category"](Sample(spark, SMALL))
    placed = [columns for label, columns in kept if label == "placed"]
    assert placed == [{"revenue_month", "category", "product_id", "net_revenue", "_part", "_place"}]


@pytest.mark.parametrize("name", [
    "fct_daily_revenue", "revenue_concentration", "mart_customer_cohorts_to_data_end", "chk_revenue_reconciles", "mq_multi_metric",
    "met_average_order_value",
])
def test_order_facts_do_not_take_the_long_chain(spark, no_broadcast, name):
    df = QUERIES[name](Sample(spark, SMALL))
    grouped = [line for line in logical(df).splitlines() if "Aggregate [order_id" in line]
    assert not [line for line in grouped if "category" in line]


def test_an_item_id_does_not_travel_through_lookups(spark, no_broadcast):
    text = logical(QUERIES["order_item_revenue"](Sample(spark, SMALL)))
    *_, units, below = text.split("Join LeftOuter")
    assert "order_item_id" not in units.split("\n", 1)[1].partition("xxhash64")[0] and below.count("xxhash64") == 2
