from datetime import date, datetime
from decimal import Decimal

import pytest
from frames import inventory, items, one, orders, products, shop, source, ts, users
from pyspark.sql import functions as F

from tallywright.config import Config
from tallywright.operators import calendar, completeness, economics, history, staging
from tallywright.plans import core, finance, marketing
from tallywright.sources.schemas import conform


def test_clamp_keeps_both_bounds(spark, cfg):
    rows = [{"order_id": i, "created_at": ts(t)} for i, t in enumerate(
        ["2019-12-31 23:59:59", "2020-01-01", "2024-12-31 23:59:59", "2025-01-01"])]
    assert sorted(r.order_id for r in staging.stage_orders(orders(spark, *rows), cfg).collect()) == [1, 2]


def test_clamp_defaults_to_now(spark):
    rows = [{"order_id": 1, "created_at": ts("2020-05-05")}, {"order_id": 2, "created_at": ts("2999-01-01")}]
    assert [r.order_id for r in staging.stage_orders(orders(spark, *rows), Config()).collect()] == [1]


def test_staged_orders_durations_and_flags(spark, cfg):
    row = one(staging.stage_orders(orders(spark, {
        "order_id": 1, "status": "Returned", "created_at": ts("2024-01-31 23:59:59"),
        "shipped_at": ts("2024-02-01 00:00:01"), "delivered_at": ts("2024-02-03 12:00:00")}), cfg))
    assert (row.days_to_ship, row.days_in_transit, row.days_to_deliver) == (1, 2, 3)
    assert (row.is_revenue_recognised, row.is_cancelled, row.is_returned) == (False, False, True)
    assert (row.ordered_date, row.ordered_month) == (date(2024, 1, 31), date(2024, 1, 1))


def test_unknown_status_has_unknown_flags(spark, cfg):
    row = one(staging.stage_orders(orders(spark, {"order_id": 1, "status": None, "created_at": ts("2024-01-01")}), cfg))
    assert row.is_revenue_recognised is None and row.is_cancelled is None


def test_staged_users_clean_up(spark, cfg):
    row = one(staging.stage_users(users(spark, {
        "id": 1, "first_name": " mary-ann ", "email": "\tA@B.C ", "age": None, "city": " ", "state": " x "}), cfg))
    assert (row.first_name, row.email, row.age_band, row.city, row.state) == ("Mary-Ann", "a@b.c", "65+", None, "x")


def test_staged_products_margin(spark):
    row = one(staging.stage_products(products(spark, {"id": 1, "retail_price": 10.0, "cost": 4.0, "brand": " "})))
    assert (row.list_margin_amount, row.list_margin_pct, row.brand) == (Decimal("6.00"), 0.6, None)
    free = one(staging.stage_products(products(spark, {"id": 1, "retail_price": 0.0, "cost": 4.0})))
    assert free.list_margin_pct is None


def test_conform_names_missing_columns(spark):
    with pytest.raises(TypeError, match="created_at"):
        conform(source(spark, "users", [{"id": 1}]).drop("created_at"), "users")
    assert conform(source(spark, "users", [{"id": 1}]).withColumn("x", F.lit(1)), "users").columns[-1] == "created_at"


def _enriched(spark, cfg, item, stock=(), product={"id": 1}):
    return one(economics.enrich_items(
        staging.stage_order_items(items(spark, {"id": 1, "order_id": 1, "created_at": ts("2024-01-01")} | item), cfg),
        staging.stage_inventory_items(inventory(spark, *stock)),
        staging.stage_products(products(spark, product))))


def test_cost_comes_from_the_unit_then_the_catalogue(spark, cfg):
    stock = [{"id": 5, "product_id": 1, "cost": 3.0}]
    assert _enriched(spark, cfg, {"inventory_item_id": 5}, stock).net_cogs == Decimal("3.00")
    assert _enriched(spark, cfg, {"inventory_item_id": 6}, stock).net_cogs == Decimal("8.00")


def test_unrecognised_units_count_nothing_but_keep_discount(spark, cfg):
    row = _enriched(spark, cfg, {"status": "Returned", "sale_price": 15.0})
    assert (row.net_revenue, row.net_cogs, row.net_units, row.returned_revenue) == (0, 0, 0, Decimal("15.00"))
    assert (row.gross_revenue, row.discount_amount, row.net_margin_pct) == (Decimal("15.00"), Decimal("5.00"), None)


def test_roll_up_counts_variety_per_order(spark, cfg):
    rows = [
        {"id": 1, "order_id": 1, "product_id": 1, "sale_price": 10.0},
        {"id": 2, "order_id": 1, "product_id": 1, "sale_price": 12.0},
        {"id": 3, "order_id": 1, "product_id": 2, "sale_price": 11.0, "status": "Cancelled"},
        {"id": 4, "order_id": 1, "product_id": None, "sale_price": 1.0},
        {"id": 5, "order_id": 2, "product_id": 3, "sale_price": 7.0},
    ]
    w = shop(spark, cfg, [], [{"created_at": ts("2024-01-01")} | r for r in rows],
             product_rows=({"id": 1, "category": "a"}, {"id": 2, "category": "b"}, {"id": 3, "category": "a"}))
    by_order = {r.order_id: r for r in w.order_rollup.collect()}
    first = by_order[1]
    assert (first.line_items, first.units_sold, first.distinct_products, first.distinct_categories) == (4, 3, 2, 2)
    assert (first.gross_revenue, first.net_revenue, first.cancelled_items) == (Decimal("34.00"), Decimal("23.00"), 1)
    assert first.sample_category == "a" and by_order[2].line_items == 1


def _sequence(spark, cfg, rows):
    staged = staging.stage_orders(orders(spark, *rows), cfg)
    return {r.order_id: r for r in history.sequence_orders(staged).collect()}


def test_purchase_sequence_skips_unrecognised_orders(spark, cfg):
    got = _sequence(spark, cfg, [
        {"order_id": 1, "user_id": 7, "created_at": ts("2024-01-05"), "status": "Cancelled"},
        {"order_id": 2, "user_id": 7, "created_at": ts("2024-03-05 10:10:00")},
        {"order_id": 3, "user_id": 7, "created_at": ts("2024-03-05 10:10:00")},
        {"order_id": 4, "user_id": 7, "created_at": ts("2024-06-05"), "status": "Returned"},
        {"order_id": 5, "user_id": 8, "created_at": ts("2024-06-05"), "status": "Cancelled"},
    ])
    assert [got[i].order_seq for i in (1, 2, 3, 4)] == [1, 2, 3, 4]
    assert [got[i].purchase_seq for i in (1, 2, 3, 4, 5)] == [None, 1, 2, None, None]
    assert [got[i].is_first_purchase for i in (1, 2, 3)] == [None, True, False]
    assert [got[i].months_since_first_purchase for i in (1, 2, 4, 5)] == [-2, 0, 3, None]
    assert got[5].cohort_month is None and got[1].cohort_month == date(2024, 3, 1)


def test_sequence_equals_plain_windows_with_a_hot_customer(spark, cfg):
    from pyspark.sql import Window as W

    df = spark.range(4000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 50 + 2).cast("bigint").alias("user_id"),
        F.expr("case id % 7 when 0 then 'Cancelled' when 1 then 'Returned' else 'Complete' end").alias("status"),
        F.lit(1).cast("bigint").alias("num_of_item"),
        F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, cast((id * 7919) % 20000 as int))").alias("created_at"),
        *(F.lit(None).cast("timestamp").alias(c) for c in ("shipped_at", "delivered_at", "returned_at")),
    )
    staged = staging.stage_orders(df, cfg).persist()
    user = W.partitionBy("user_id").orderBy("ordered_at", "order_id")
    plain = staged.select(
        "order_id",
        F.row_number().over(user).alias("order_seq"),
        F.when(F.col("is_revenue_recognised"),
               F.row_number().over(W.partitionBy("user_id", "is_revenue_recognised").orderBy("ordered_at", "order_id"))
               ).alias("purchase_seq"),
        F.max(F.when(F.col("is_revenue_recognised"), F.col("ordered_at"))).over(W.partitionBy("user_id")).alias("latest_purchase_at"),
    )
    ours = history.sequence_orders(staged).select(plain.columns)
    assert ours.count() == 4000
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def _boundary(spark, cfg, order_days, with_items):
    o = staging.stage_orders(orders(spark, *({"order_id": i, "created_at": ts(d)} for i, d in enumerate(order_days))), cfg)
    return completeness.completeness_boundary(o, spark.createDataFrame([(i,) for i in with_items], "order_id bigint"), cfg)


def test_boundary_is_the_day_before_the_first_gap_less_settling(spark, cfg):
    days = ["2024-01-01", "2024-01-10", "2024-01-12"]
    assert one(_boundary(spark, cfg, days, [0, 2]))[0] == date(2024, 1, 6)
    assert one(_boundary(spark, cfg, days, [0, 1, 2]))[0] == date(2024, 1, 9)  # no gap
    assert one(_boundary(spark, cfg, [], []))[0] is None


def test_orders_without_items_have_null_economics(spark, cfg):
    w = shop(spark, cfg, [{"order_id": 1, "user_id": 1, "created_at": ts("2024-01-01")}], [])
    row = one(w.fct_orders)
    assert row.has_line_items is False and row.net_revenue is None and row.net_margin_pct is None
    customer = one(w.dim_customers)
    assert customer.avg_order_value is None and customer.lifetime_net_revenue == 0
    assert (customer.lifetime_orders, customer.lifetime_orders_missing_economics) == (1, 1)


def test_customers_are_measured_against_the_last_order_in_the_data(spark, cfg):
    w = shop(
        spark, cfg,
        [
            {"order_id": 1, "user_id": 1, "created_at": ts("2024-04-01")},
            {"order_id": 2, "user_id": 2, "created_at": ts("2024-01-01")},
            {"order_id": 3, "user_id": 2, "created_at": ts("2024-06-30"), "status": "Cancelled"},
            {"order_id": 4, "user_id": 3, "created_at": ts("2023-01-01")},
        ],
        [{"id": i, "order_id": i, "created_at": ts("2024-01-01"), "sale_price": 30.01} for i in (1, 2, 4)],
        user_rows=({"id": 1}, {"id": 2}, {"id": 3}, {"id": 4}),
    )
    got = {r.user_id: r for r in w.dim_customers.collect()}
    assert {k: r.customer_status for k, r in got.items()} == {
        1: "Active - new", 2: "Lapsing", 3: "Churned", 4: "Never purchased"}
    assert got[1].days_since_last_order == 90 and got[1].is_active is True and got[2].is_active is False
    assert got[4].is_active is None and got[4].as_of_date == date(2024, 6, 30)
    assert got[2].lifetime_cancelled_orders == 1 and got[2].lifetime_orders_placed == 2


def test_average_divides_by_all_recognised_orders(spark, cfg):
    w = shop(spark, cfg, [{"order_id": i, "user_id": 1, "created_at": ts("2024-01-01")} for i in (1, 2)],
             [{"id": 1, "order_id": 1, "created_at": ts("2024-01-01"), "sale_price": 10.01}])
    assert one(w.dim_customers).avg_order_value == Decimal("5.01")


def test_days_without_orders_are_zero_with_unknown_ratios(spark, cfg):
    w = shop(spark, cfg,
             [{"order_id": 1, "user_id": 1, "created_at": ts("2024-01-01")}, {"order_id": 2, "user_id": 1, "created_at": ts("2024-01-04")}],
             [{"id": 1, "order_id": 1, "created_at": ts("2024-01-01"), "sale_price": 7.0},
              {"id": 2, "order_id": 2, "created_at": ts("2024-01-04"), "sale_price": 3.0}])
    rows = w.fct_daily_revenue.orderBy("revenue_date").collect()
    assert [r.revenue_date.day for r in rows] == [1, 2, 3, 4]
    assert (rows[1].orders_placed, rows[1].net_revenue, rows[1].avg_order_value) == (0, 0, None)
    assert [str(r.net_revenue_7d_avg) for r in rows] == ["7.00", "3.50", "2.33", "2.50"]
    assert [r.is_revenue_complete for r in rows] == [True, False, False, False]


def test_no_complete_day_leaves_the_flag_unknown(spark, cfg):
    w = shop(spark, cfg, [{"order_id": 1, "user_id": 1, "created_at": ts("2024-01-01")}], [])
    assert one(w.fct_daily_revenue).is_revenue_complete is None


def test_same_weekday_last_year(spark, cfg):
    w = shop(spark, cfg,
             [{"order_id": 1, "user_id": 1, "created_at": ts("2023-01-02")}, {"order_id": 2, "user_id": 1, "created_at": ts("2024-01-01")}],
             [{"id": 1, "order_id": 1, "created_at": ts("2023-01-02"), "sale_price": 7.0}])
    last = w.fct_daily_revenue.orderBy(F.desc("revenue_date")).first()
    assert last.net_revenue_ly == Decimal("7.00") and last.revenue_date == date(2024, 1, 1)


def _cohorts(spark, cfg):
    days = [(1, 1, "2024-01-10"), (2, 1, "2024-04-10"), (3, 2, "2024-01-20"), (4, 3, "2024-06-01")]
    w = shop(spark, cfg, [{"order_id": o, "user_id": u, "created_at": ts(d)} for o, u, d in days],
             [{"id": o, "order_id": o, "created_at": ts(d), "sale_price": 10.0} for o, _, d in days],
             user_rows=({"id": 1}, {"id": 2}, {"id": 3}))
    return w


def test_cohort_grid_keeps_idle_months(spark, cfg):
    rows = _cohorts(spark, cfg).mart_customer_cohorts.orderBy("cohort_month", "months_since_first_purchase").collect()
    first = [r for r in rows if r.cohort_month == date(2024, 1, 1)]
    assert [r.months_since_first_purchase for r in first] == [0, 1, 2, 3]
    assert [r.active_customers for r in first] == [2, 0, 0, 1]
    assert [str(r.retention_rate) for r in first] == ["1.0000", "None", "None", "0.5000"]
    assert [str(r.cumulative_ltv) for r in first] == ["10.00", "10.00", "10.00", "15.00"]


def test_cohort_grid_to_the_end_of_the_data(spark, cfg):
    from dataclasses import replace

    w = _cohorts(spark, cfg)
    rows = marketing.mart_customer_cohorts(w.cohort_activity, replace(cfg, cohort_grid_end="data"))
    assert rows.groupBy("cohort_month").count().orderBy("cohort_month").collect()[0][1] == 6
    with pytest.raises(ValueError):
        marketing.fill_cohort_months(w.cohort_activity, "never")


def test_grid_helper_does_not_count_down(spark):
    df = spark.sql("select cast(-1 as bigint) n union all select 2")
    assert sorted(r[0] for r in df.select(F.explode(calendar.each_number(F.col("n")))).collect()) == [0, 1, 2]


def test_time_spine_covers_the_project_calendar(spark):
    spine = calendar.time_spine(spark, Config())
    assert spine.count() == 4383
    row = spine.where("date_day = date'2024-06-02'").first()
    assert row[:] == (date(2024, 6, 2), date(2024, 5, 27), date(2024, 6, 1), date(2024, 4, 1), date(2024, 1, 1))


def test_stock_averages_sold_units_only(spark):
    df = staging.stage_inventory_items(inventory(
        spark,
        {"id": 1, "product_id": 1, "cost": 1.0, "created_at": ts("2024-01-01"), "sold_at": ts("2024-01-04")},
        {"id": 2, "product_id": 1, "cost": 2.01, "created_at": ts("2024-01-01"), "sold_at": ts("2024-01-05")},
        {"id": 3, "product_id": 1, "cost": 2.0, "created_at": ts("2024-01-01"), "sold_at": None}))
    row = one(core.inventory_by_product(df))
    assert (row.units_stocked, row.units_sold_all_time) == (3, 2)
    assert (str(row.avg_unit_cost), str(row.avg_days_on_shelf)) == ("1.67", "3.5")


def test_revenue_agrees_at_every_grain(spark):
    from conftest import SMALL

    from tallywright.catalog.queries import Sample

    w = Sample(spark, SMALL)

    def total(df):
        return df.agg(F.sum("net_revenue")).first()[0]

    expected = total(w.fct_order_items)
    assert total(w.fct_orders) == expected
    assert total(w.fct_daily_revenue) == expected
    assert total(finance.product_month(w.fct_order_items)) == expected
    assert total(w.mart_customer_cohorts) == expected


def test_config_is_read_by_orders_and_items_alike(spark):
    cfg = Config(clamp_ts=datetime(2024, 12, 31), revenue_statuses=("Returned",))
    w = shop(spark, cfg, [{"order_id": 1, "user_id": 1, "status": "Returned", "created_at": ts("2024-01-01")}],
             [{"id": 1, "order_id": 1, "status": "Returned", "created_at": ts("2024-01-01")}])
    row = one(w.fct_orders)
    assert row.is_revenue_recognised and row.net_revenue == Decimal("10.00")


def test_ranks_of_a_catalogue_with_repeated_products(spark):
    """Each row of a product month meets each of its ranks, whichever way the ranks are taken."""
    rows = [(1, p, c, float(v)) for p, c, v in [(1, "a", 5), (1, "a", 5), (2, "a", 7), (3, "b", 1), (3, "c", 1), (None, "a", 2)]]
    df = spark.createDataFrame(rows, "revenue_month int, product_id int, category string, net_revenue double")
    named = finance.ranked_in_category(df, df.select("product_id", "category"))
    got = sorted((r.product_id or 0, r.category, r.revenue_rank_in_category) for r in named.collect())
    assert got == [
        (0, "a", 4), (1, "a", 2), (1, "a", 2), (1, "a", 3), (1, "a", 3), (2, "a", 1),
        (3, "b", 1), (3, "b", 1), (3, "c", 1), (3, "c", 1),
    ]
    single = df.where("product_id = 2 or product_id is null")
    got = finance.ranked_in_category(single, single.select("product_id", "category")).collect()
    assert sorted((r.product_id or 0, r.revenue_rank_in_category) for r in got) == [(0, 2), (2, 1)]
