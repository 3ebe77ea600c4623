"""Every named query equals its SQL twin, row for row, on the smallest test data."""

import pytest
from compare import connect, difference
from conftest import SMALL

from tallywright.catalog.oracle import ORACLES
from tallywright.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(name, spark, con):
    assert difference(name, spark, con, SMALL) is None


def test_expected_totals(spark):
    """Known values of the smallest data set."""
    from pyspark.sql import functions as F

    from tallywright.catalog.queries import Sample

    w = Sample(spark, SMALL)
    assert (w.users.count(), w.orders.count(), w.order_items.count()) == (160, 1500, 6000)
    assert w.inventory_items.count() == 6200 and w.events.count() == 1000
    totals = w.fct_orders.agg(
        F.count_if("is_revenue_complete"), F.count_if("is_revenue_recognised"), F.sum("net_revenue").cast("string"),
        F.count_if(~F.col("has_line_items")), F.countDistinct("cohort_month"),
    ).first()
    assert tuple(totals) == (1467, 1124, "640503.75", 27, 30)
    segments = dict(w.dim_customers.groupBy("customer_status").count().collect())
    assert segments == {"Never purchased": 10, "Active - repeat": 52, "Lapsing": 50, "Churned": 48}
