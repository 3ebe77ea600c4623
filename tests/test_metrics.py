from datetime import date
from decimal import Decimal

import pytest

from tallywright.plans import metrics


@pytest.fixture(scope="module")
def frames(spark):
    orders = spark.sql("""
        select *, order_status in ('Complete') is_revenue_recognised, order_status = 'Cancelled' is_cancelled,
               false is_returned, true is_revenue_complete, false is_first_purchase, false is_repeat_purchase,
               date'2024-01-01' cohort_month, cast(1 as decimal(18,2)) net_gross_profit,
               cast(1 as decimal(18,2)) net_cogs, cast(1 as bigint) units_sold
        from values (1L, 1L, 'Complete', date'2024-01-15', cast(10.00 as decimal(18,2))),
                    (2L, 1L, 'Complete', date'2024-01-20', cast(30.00 as decimal(18,2))),
                    (3L, 2L, 'Cancelled', date'2024-02-20', cast(0.00 as decimal(18,2))),
                    (4L, 9L, 'Complete', date'2024-04-20', cast(50.00 as decimal(18,2)))
        t(order_id, user_id, order_status, ordered_date, net_revenue)""")
    customers = spark.sql("""
        select user_id, date'2024-01-01' registered_date, date'2024-01-01' cohort_month, source traffic_source,
               'X' country, '18-24' age_band, 'F' gender, 'Churned' customer_status, false is_active,
               true has_purchased, false is_repeat_customer, cast(5 as decimal(18,2)) lifetime_net_revenue
        from values (1L, 'Search'), (2L, cast(null as string)) t(user_id, source)""")
    items = spark.sql("""
        select id order_item_id, order_id, 1L product_id, date'2024-01-15' ordered_date, 'c' category, 'Men' department,
               'b' brand, 'Complete' item_status, cast(3 as decimal(18,2)) net_revenue, 1L net_units, false is_returned
        from values (1L, 1L), (2L, 1L), (3L, 3L), (4L, 77L) t(id, order_id)""")
    return {"fct_orders": orders, "dim_customers": customers, "fct_order_items": items}.get


def rows(df):
    return {tuple(r)[:-1] if len(r) > 2 else r[0]: r[-1] for r in df.collect()}


def test_declared_counts():
    assert len(metrics.METRICS) == 23
    assert sum(m.measure is not None for m in metrics.METRICS.values()) == 14
    assert sum(m.numerator is not None for m in metrics.METRICS.values()) == 8
    assert sum(len(m.measures) for m in metrics.MODELS.values()) == 19
    assert sum(len(m.time_dimensions) + len(m.categorical) for m in metrics.MODELS.values()) == 20
    assert sum(1 + len(m.foreign) for m in metrics.MODELS.values()) == 6


def test_total_without_groups(frames):
    row = metrics.metric_query(frames, ["net_revenue", "order_count", "orders_placed", "purchasing_customers"]).first()
    assert row[:] == (Decimal("90.00"), 3, 4, 3)


def test_ratio_divides_aggregates(frames):
    got = rows(metrics.metric_query(frames, ["average_order_value"], ["metric_time__month"]))
    assert got == {date(2024, 1, 1): 20.0, date(2024, 2, 1): None, date(2024, 4, 1): 50.0}


def test_growth_uses_the_calendar_not_the_previous_row(frames):
    got = rows(metrics.metric_query(frames, ["net_revenue_mom_growth"], ["metric_time__month"]))
    assert got == {date(2024, 1, 1): None, date(2024, 2, 1): -1.0, date(2024, 4, 1): None}


def test_growth_needs_an_aligned_time(frames):
    with pytest.raises(ValueError):
        metrics.metric_query(frames, ["net_revenue_mom_growth"], ["order_status"])


def test_growth_by_day_looks_back_from_each_day(spark, frames):
    """Several days may look back to the same last day of a short month."""
    days = {"2024-01-28": 100, "2024-01-29": 200, "2024-01-30": 300, "2024-01-31": 400, "2024-02-29": 1000, "2024-03-30": 500, "2024-03-31": 100}
    base = frames("fct_orders").limit(1)
    orders = spark.createDataFrame([(date.fromisoformat(d), Decimal(v)) for d, v in days.items()], "d date, v decimal(18,2)")
    orders = base.crossJoin(orders).withColumns({"ordered_date": orders.d, "net_revenue": orders.v}).drop("d", "v")
    known = {"fct_orders": orders}.get
    got = rows(metrics.metric_query(known, ["net_revenue_mom_growth"], ["metric_time__day"]))
    growth = {"2024-02-29": 4.0, "2024-03-30": -0.5, "2024-03-31": -0.9}
    assert got == {date.fromisoformat(d): growth.get(d) for d in days}


def test_growth_at_longer_grains(frames):
    def by(grain):
        return rows(metrics.metric_query(frames, ["net_revenue_mom_growth"], ["metric_time"], grain=grain))

    assert by("quarter") == {date(2024, 1, 1): None, date(2024, 4, 1): 0.25}
    assert by("year") == {date(2024, 1, 1): None}
    assert by("week") == {date(2024, 1, 15): None, date(2024, 2, 19): -1.0, date(2024, 4, 15): None}


def test_joined_dimension_keeps_unknown_customers(frames):
    got = rows(metrics.metric_query(frames, ["orders_placed"], ["customer__traffic_source"]))
    assert got == {"Search": 2, None: 2}


def test_two_hops_and_where(frames):
    got = rows(metrics.metric_query(frames, ["line_item_measure"], ["order__customer__traffic_source"]))
    assert got == {"Search": 2, None: 2}
    kept = metrics.metric_query(
        frames, ["line_item_measure"], ["order__customer__traffic_source"],
        where=lambda d: d("order__order_status") == "Cancelled")
    assert rows(kept) == {None: 1}


def test_several_models_line_up_on_null_groups(frames):
    got = metrics.metric_query(frames, ["orders_placed", "registered_customers"], ["customer__traffic_source"]).collect()
    assert sorted(map(tuple, got), key=str) == [("Search", 2, 1), (None, 2, 1)]


def test_several_models_by_time(frames):
    got = metrics.metric_query(
        frames, ["net_revenue", "item_units_measure", "registered_customers"], ["metric_time"], grain="year").collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 1), Decimal("90.00"), 4, 2)]


def test_zero_fill_inserts_missing_months(frames):
    got = rows(metrics.metric_query(frames, ["orders_placed"], ["metric_time__month"], fill_zero=True))
    assert got == {date(2024, 1, 1): 2, date(2024, 2, 1): 1, date(2024, 3, 1): 0, date(2024, 4, 1): 1}
    with pytest.raises(ValueError):
        metrics.metric_query(frames, ["orders_placed"], ["order_status"], fill_zero=True)


def test_zero_fill_covers_a_range_for_every_group(frames):
    """Head, gaps and tail of each group, the one without a source included; ratios stay null."""
    asked = ["orders_placed", "average_order_value"]
    got = metrics.metric_query(
        frames, asked, ["customer__traffic_source", "metric_time__month"], fill_zero=(date(2023, 12, 10), date(2024, 5, 31)))
    by_group = {}
    for source, month, placed, value in got.collect():
        by_group.setdefault(source, {})[month] = (placed, value)
    months = [date(2023, 12, 1), *(date(2024, m, 1) for m in range(1, 6))]
    assert {k: sorted(v) for k, v in by_group.items()} == {"Search": months, None: months}
    assert by_group["Search"][date(2024, 1, 1)] == (2, 20.0) and by_group["Search"][date(2024, 2, 1)] == (0, None)
    assert by_group[None][date(2024, 2, 1)] == (1, None) and by_group[None][date(2024, 4, 1)] == (1, 50.0)


@pytest.mark.parametrize("first, last, n", [("2024-01-01", "2024-01-31", 1), ("2025-01-01", "2025-02-01", 2), ("2020-01-01", "2020-01-05", 1), ("2024-02-01", "2024-03-31", 2)])
def test_zero_fill_keeps_to_its_range(frames, first, last, n):
    got = metrics.metric_query(
        frames, ["orders_placed"], ["metric_time__month", "customer__traffic_source"],
        fill_zero=(date.fromisoformat(first), date.fromisoformat(last))).collect()
    assert len(got) == 2 * n and all(date.fromisoformat(first) <= r[0] <= date.fromisoformat(last) for r in got)
    real = {(date(2024, 1, 1), "Search"): 2, (date(2024, 2, 1), None): 1, (date(2024, 4, 1), None): 1}
    assert all(r.orders_placed == real.get((r[0], r[1]), 0) for r in got)


def test_zero_fill_over_a_time_spine(spark, frames):
    spine = spark.sql("select explode(sequence(date'2024-01-14', date'2024-01-21')) date_day")
    got = rows(metrics.metric_query(frames, ["orders_placed"], ["metric_time"], fill_zero=spine))
    assert got == {date(2024, 1, d): int(d in (15, 20)) for d in range(14, 22)}
    # an empty spine bounds nothing: only the gaps are filled
    assert metrics.metric_query(frames, ["orders_placed"], ["metric_time"], fill_zero=spine.limit(0)).count() == 97


def test_all_grains_at_once_equal_one_by_one(frames):
    asked, by = ["net_revenue", "average_order_value", "purchasing_customers"], ["metric_time", "customer__traffic_source"]
    every = metrics.metric_query(frames, asked, by, grains=("day", "month", "year"))
    assert every.columns == ["grain", *by, *asked]
    for grain in ("day", "month", "year"):
        alone = metrics.metric_query(frames, asked, by, grain=grain)
        assert sorted(map(str, alone.collect())) == sorted(map(str, every.where(f"grain = '{grain}'").drop("grain").collect()))
    with pytest.raises(ValueError):
        metrics.metric_query(frames, asked, ["customer__traffic_source"], grains=("day",))
    with pytest.raises(ValueError):
        metrics.metric_query(frames, ["net_revenue_mom_growth"], ["metric_time"], grains=("day",))


def test_distinct_counts_survive_joins_below_them(frames):
    got = rows(metrics.metric_query(
        frames, ["purchasing_customers"], ["customer__traffic_source"], where=lambda d: d("order_status") == "Complete"))
    assert got == {"Search": 1, None: 1}


@pytest.mark.parametrize("group", ["product__brand", "nothing", "customer__order_status"])
def test_unreachable_dimensions(frames, group):
    with pytest.raises(KeyError):
        metrics.metric_query(frames, ["orders_placed"], [group])


def test_unknown_metric(frames):
    with pytest.raises(KeyError):
        metrics.metric_query(frames, ["profit"])


def test_order_facts_are_the_order_mart_without_variety(spark):
    from tallywright.catalog.queries import Sample

    w = Sample(spark, "/root/testdata/sf0.001")
    mart, facts = w.fct_orders.drop("distinct_products", "distinct_categories"), w.order_facts
    assert facts.columns == mart.columns
    assert sorted(map(tuple, facts.collect()), key=repr) == sorted(map(tuple, mart.collect()), key=repr)
