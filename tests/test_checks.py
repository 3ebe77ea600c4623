"""Every check passes on clean frames and fires on a frame made to break it."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from frames import shop, ts
from pyspark.sql import functions as F

from tallywright.catalog.queries import QUERIES
from tallywright.config import Config
from tallywright.operators import checks
from tallywright.plans import contracts, invariants
from tallywright.plans.contracts import CONTRACTS
from tallywright.sources.tables import freshness


def test_declared_contracts():
    kinds = {}
    for c in CONTRACTS:
        kinds[c.check] = kinds.get(c.check, 0) + 1
    assert kinds == {"not_null": 57, "unique": 21, "accepted_range": 18, "relationships": 11, "accepted_values": 9,
                     "unique_combination": 3}
    assert sum(c.where is not None for c in CONTRACTS) == 8
    assert sum(c.severity == "warn" for c in CONTRACTS) == 1
    assert len(invariants.ROW_INVARIANTS) + len(invariants.FRAME_INVARIANTS) == 10


def _values(spark, rows, schema="k int, v double"):
    return spark.createDataFrame(rows, schema)


def test_duplicates(spark):
    df = _values(spark, [(1, 1.0), (1, 2.0), (2, 1.0), (None, 1.0), (None, 1.0)])
    assert [tuple(r) for r in checks.duplicates(df, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in checks.duplicates(df, "k", "v").collect()] == [(None, 1.0, 2)]
    assert checks.duplicates(df, "k", where="v < 2").count() == 0


def test_row_rules(spark):
    df = _values(spark, [(1, -1.0), (2, 0.0), (3, 1.0), (None, None)])

    def broken(rule, where=None):
        return [r.k for r in checks.violations(df, rule, where).collect()]

    assert broken(checks.null_rule("v")) == [None]
    assert broken(checks.null_rule("v"), "k is not null") == []
    assert broken(checks.value_rule("k", (1, 2))) == [3]
    assert broken(checks.range_rule("v", 0)) == [1]
    assert broken(checks.range_rule("v", 0, inclusive=False)) == [1, 2]
    assert broken(checks.range_rule("v", -1, 0)) == [3]
    assert broken(checks.range_rule("v")) == []


def test_orphans_are_counted_per_key(spark):
    child = _values(spark, [(1, 0.0), (9, 0.0), (9, 1.0), (None, 0.0)])
    parent = _values(spark, [(1, 0.0)])
    assert [tuple(r) for r in checks.orphans(child, "k", parent, "k").collect()] == [(9, 2)]


def test_every_declared_reference_is_looked_up(spark, cfg):
    day = {"created_at": ts("2024-02-05")}
    w = shop(
        spark, cfg,
        [{"order_id": 1, "user_id": 1, **day}, {"order_id": 2, "user_id": 9, **day}, {"order_id": 3, "user_id": None, **day}],
        [{"id": 1, "order_id": 1, "inventory_item_id": 44, **day}, {"id": 2, "order_id": 5, "product_id": 7, **day},
         {"id": 3, "order_id": 5, "product_id": 7, **day}, {"id": 4, "order_id": 3, "product_id": None, **day}],
        inventory_rows=[{"id": 4, "product_id": 8}],
    )
    lost = {(r.table_name, r.column_name, r.key): r.n_rows for r in QUERIES["semi_fk"](w).collect()}
    assert lost == {
        ("source.orders", "user_id", 9): 1, ("source.order_items", "order_id", 5): 2, ("source.order_items", "product_id", 7): 2,
        ("orders", "user_id", 9): 1, ("order_items", "order_id", 5): 2, ("order_items", "product_id", 7): 2,
        ("order_items", "inventory_item_id", 44): 1, ("inventory_items", "product_id", 8): 1, ("fct_orders", "user_id", 9): 1,
        ("fct_order_items", "order_id", 5): 2, ("fct_order_items", "product_id", 7): 2, ("orders", "order_id", 2): 1,
    }


def test_a_conditional_reference_leaves_out_other_rows(spark):
    frames = {"a": _values(spark, [(1, 0.0), (8, 0.0), (9, 1.0), (None, 1.0)]), "b": _values(spark, [(1, 0.0), (None, 0.0)])}
    refers = [contracts.Contract("relationships", "a", ("k",), parent="b", parent_key="k", where="v > 0")]
    assert [tuple(r) for r in contracts.lost_references(frames.get, refers).collect()] == [("a", "k", 9, 1)]


def test_report_counts_failures_of_every_kind(spark):
    frames = {
        "a": _values(spark, [(1, -1.0), (1, 5.0), (7, None)]),
        "b": _values(spark, [(1, 1.0)]),
    }
    declared = [
        contracts.Contract("unique", "a", ("k",)),
        contracts.Contract("unique", "b", ("k",)),
        contracts.Contract("unique_combination", "a", ("k", "v")),
        contracts.Contract("relationships", "a", ("k",), parent="b", parent_key="k"),
        contracts.Contract("not_null", "a", ("v",)),
        contracts.Contract("accepted_range", "a", ("v",), min_value=0, severity="warn"),
        contracts.Contract("accepted_values", "a", ("k",), values=("1",), where="v is not null"),
    ]
    got = {
        (r.check_name, r.table_name): r.failures
        for part in (
            contracts.key_failures(frames.get, declared[:3]),
            contracts.reference_failures(frames.get, declared[3:4]),
            contracts.row_failures(frames.get, [
                (c.table, contracts._contract_label(c), c.row_rule() if c.where is None else F.expr(c.where) & c.row_rule())
                for c in declared[4:]]),
        )
        for r in part.collect()
    }
    assert got == {
        ("unique", "a"): 1, ("unique", "b"): 0, ("unique_combination", "a"): 0, ("relationships", "a"): 1,
        ("not_null", "a"): 1, ("accepted_range", "a"): 1, ("accepted_values", "a"): 0}
    for c in declared:
        assert c.violations(frames.get).count() == got[(c.check, c.table)]




@pytest.fixture
def sound(spark, cfg):
    days = ["2024-02-05", "2024-02-10"]
    return shop(
        spark, cfg,
        [{"order_id": i, "user_id": 1, "created_at": ts(d)} for i, d in enumerate(days)],
        [{"id": i, "order_id": i, "created_at": ts(d)} for i, d in enumerate(days)],
    )


def _broken(sound, mart, **columns):
    def frames(name):
        df = sound.frame(name)
        for column, value in (columns if name == mart else {}).items():
            df = df.withColumn(column, value.cast(df.schema[column].dataType))
        return df

    return frames


@pytest.mark.parametrize(
    "name, mart, columns",
    [
        ("cancelled_orders_have_zero_revenue", "fct_orders", {"order_status": "Returned"}),
        ("complete_orders_have_items", "fct_orders", {"is_revenue_complete": True, "has_line_items": False}),
        ("incomplete_orders_have_null_revenue", "fct_orders", {"has_line_items": False}),
        ("no_future_orders", "fct_orders", {"ordered_at": "2025-01-01"}),
        ("cohort_starts_at_full_retention", "mart_customer_cohorts", {"retention_rate": 0.9998}),
        ("first_order_not_before_registration", "dim_customers", {"registered_date": "2024-02-06"}),
        ("unknown_value_is_not_zero", "dim_customers", {"lifetime_orders_missing_economics": 2}),
        ("completeness_window_is_sane", "fct_orders", {"is_revenue_complete": False}),
        ("order_revenue_ties_to_items", "fct_orders", {"net_revenue": 10.02}),
    ],
)
def test_assertions_hold_and_fire(sound, cfg, name, mart, columns):
    assert invariants.invariant(name, sound.frame, cfg).count() == 0
    frames = _broken(sound, mart, **{c: F.lit(v) for c, v in columns.items()})
    assert invariants.invariant(name, frames, cfg).count() > 0


def test_reconciliation_tolerates_a_cent(sound, cfg):
    frames = _broken(sound, "fct_orders", net_revenue=F.lit(10.01))
    assert invariants.invariant("order_revenue_ties_to_items", frames, cfg).count() == 0


def test_an_old_orphan_trips_the_window(spark, cfg):
    w = shop(spark, cfg,
             [{"order_id": 1, "user_id": 1, "created_at": ts("2024-01-01")}, {"order_id": 2, "user_id": 1, "created_at": ts("2024-03-01")}],
             [{"id": 2, "order_id": 2, "created_at": ts("2024-03-01")}])
    assert invariants.invariant("completeness_window_is_sane", w.frame, cfg).first().complete_through is None


def test_volume_spikes_and_drops_are_found(spark):
    days = [(date(2024, 1, 1 + i), True, 100) for i in range(29)]
    days += [(date(2024, 1, 30), True, 300), (date(2024, 1, 31), True, 20), (date(2024, 2, 1), False, 900)]
    daily = spark.createDataFrame(days, "revenue_date date, is_revenue_complete boolean, orders_placed bigint")
    found = {r.revenue_date.day: r.ratio for r in invariants.implausible_volume(daily, Config()).collect()}
    assert found == {30: 3.0, 31: 0.19}
    assert invariants.implausible_volume(daily, replace(Config(), volume_warm_up=200)).count() == 0


def test_freshness_grades_age(spark):
    def table(text):
        return spark.sql(f"select timestamp'{text}' created_at")

    now = F.lit(datetime(2024, 1, 10)).cast("timestamp")
    got = freshness(
        {"users": table("2024-01-09 01:00:00"), "orders": table("2024-01-08 23:00:00"), "events": table("2024-01-06 23:00:00"),
         "order_items": table("2024-01-09 01:00:00").where("false"), "distribution_centers": table("2000-01-01")}, now, Config())
    assert {r.table_name: r.status for r in got.collect()} == {
        "users": "pass", "orders": "warn", "events": "error", "order_items": "error"}
