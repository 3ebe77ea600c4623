"""DuckDB SQL for the named queries, written independently of the Spark plans.

``RELATIONS`` holds one SELECT per relation over the raw test tables. A query
takes the relations it mentions (and theirs) as CTEs. Ratios are rounded with
integer arithmetic, so ties do not depend on binary floats. Every result column
is cast to a plain type: counts BIGINT, amounts and rates DOUBLE.
"""

from __future__ import annotations

import re

from tallywright.functions import fixed_values as fixed
from tallywright.plans.core import ITEM_COLUMNS, ORDER_COLUMNS


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def ratio(n: str, d: str, digits: int) -> str:
    """n / d rounded half away from zero, null when d is 0 or null."""
    a, b = (f"CAST(CAST(({x}) AS DECIMAL(26,2)) * 100 AS HUGEINT)" for x in (n, d))
    size = f"(2 * abs({a}) * {10**digits} + abs({b})) // (2 * abs({b}))"
    return f"(CASE WHEN ({d}) <> 0 THEN sign({a}) * sign({b}) * ({size}) / {10**digits}.0 END)"


def _band(c: str, bands) -> str:
    cases = " ".join(f"WHEN {c} < {bound} THEN '{label}'" for bound, label in bands if bound is not None)
    return f"CASE {cases} ELSE '{bands[-1][1]}' END"


_BLANKS = "|| ".join(f"chr({ord(ch)})" for ch in fixed.WHITESPACE)


def _clean(c: str) -> str:
    return f"nullif(trim({c}, {_BLANKS}), '')"


def _title(c: str) -> str:
    marks = fixed.NAME_DELIMITERS.replace("'", "''")
    return (
        f"list_aggregate(list_transform(range(1, length(trim({c}, {_BLANKS})) + 1), lambda i: CASE WHEN i = 1 OR "
        f"contains('{marks}' || {_BLANKS}, lower(trim({c}, {_BLANKS}))[i - 1]) THEN upper(trim({c}, {_BLANKS})[i]) "
        f"ELSE lower(trim({c}, {_BLANKS})[i]) END), 'string_agg', '')"
    )


_STATUSES = _quoted(fixed.REVENUE_STATUSES)
_LINE_ID = (
    "('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)), "
    "CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15))::BIGINT"
)


def _status(code: str, key: str) -> str:
    return (
        f"CASE {code} WHEN 'F' THEN if({key} % 4 = 0, 'Returned', 'Complete') "
        f"WHEN 'O' THEN if({key} % 4 = 1, 'Cancelled', 'Shipped') "
        f"WHEN 'P' THEN if({key} % 4 = 2, 'Cancelled', 'Processing') END"
    )


_SHIPPED = "CASE WHEN status IN ('Shipped', 'Complete', 'Returned') THEN created_at + to_days(CAST(1 + order_id % 3 AS INT)) END"
_DELIVERED = (
    "CASE WHEN status IN ('Complete', 'Returned') THEN "
    "created_at + to_days(CAST(3 + order_id % 3 + order_id % 4 AS INT)) END"
)
_RETURNED = "CASE WHEN status = 'Returned' THEN created_at + to_days(CAST(8 + order_id % 3 + order_id % 4 AS INT)) END"
_FLAGS = (
    f"status IN ({_STATUSES}) AS is_revenue_recognised, status = 'Cancelled' AS is_cancelled, "
    "status = 'Returned' AS is_returned"
)
_IN_WINDOW = "created_at >= TIMESTAMP '1994-01-01' AND created_at <= TIMESTAMP '2001-08-01'"

RELATIONS: dict[str, str] = {
    # the raw tables as the seven sources
    "places": "SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey",
    "src_users": """
        SELECT c_custkey AS id, ' ' || lower(c_mktsegment) || ' ' AS first_name, 'SMITH' AS last_name,
               ' ' || upper(c_name) || '@EXAMPLE.COM' AS email, 18 + c_custkey % 60 AS age,
               if(c_custkey % 2 = 0, 'M', 'F') AS gender, n_name AS city, r_name AS state,
               if(c_custkey % 11 = 0, '  ', CAST(10000 + c_custkey AS VARCHAR)) AS postal_code, n_name AS country,
               CAST(n_nationkey AS DOUBLE) AS latitude, CAST(2 * n_nationkey AS DOUBLE) AS longitude,
               c_mktsegment AS traffic_source, TIMESTAMP '1994-01-01' + to_days(CAST(c_custkey % 360 AS INT)) AS created_at
        FROM customer JOIN places ON c_nationkey = n_nationkey
        UNION ALL
        SELECT 1000000 + s_suppkey, ' ' || lower(s_name), 'SMITH', s_name || '@EXAMPLE.COM', 18 + s_suppkey % 60, 'F',
               n_name, r_name, '', n_name, 0.0, 0.0, 'BUILDING',
               TIMESTAMP '1994-06-01' + to_days(CAST(s_suppkey % 200 AS INT))
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "heads": f"""
        SELECT o_orderkey AS order_id, o_custkey AS user_id, {_status('o_orderstatus', 'o_orderkey')} AS status,
               o_orderdate AS created_at FROM orders""",
    "src_orders": f"""
        SELECT *, {_SHIPPED} AS shipped_at, {_DELIVERED} AS delivered_at, {_RETURNED} AS returned_at
        FROM (SELECT order_id, user_id, status, coalesce(n, 1) AS num_of_item,
                     CASE WHEN n IS NULL THEN TIMESTAMP '2001-07-30' + to_days(CAST(order_id % 3 AS INT))
                          ELSE created_at END AS created_at
              FROM heads LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = order_id)""",
    "src_items": f"""
        SELECT {_LINE_ID} AS id, order_id, user_id, l_partkey AS product_id, {_LINE_ID} AS inventory_item_id, status,
               (cents - floor(cents * CAST(round(l_discount * 100) AS BIGINT) / 100.0)) / 100.0 AS sale_price,
               created_at, {_SHIPPED} AS shipped_at, {_DELIVERED} AS delivered_at, {_RETURNED} AS returned_at
        FROM (SELECT *, 1099 + (l_partkey * 700) % 29000 AS cents FROM lineitem) JOIN heads ON l_orderkey = order_id""",
    "src_inventory": f"""
        SELECT {_LINE_ID} + if(l_linenumber = 7 AND l_orderkey % 50 = 0, 1152921504606846976, 0) AS id,
               l_partkey AS product_id, l_partkey % 25 AS distribution_center_id,
               floor((1099 + (l_partkey * 700) % 29000) * (40 + l_suppkey % 20) / 100.0) / 100.0 AS cost,
               l_shipdate - to_days(CAST(10 + l_linenumber AS INT)) AS created_at, l_shipdate AS sold_at
        FROM lineitem
        UNION ALL
        SELECT 1000000000000 + p_partkey, p_partkey, p_partkey % 25,
               floor((1099 + (p_partkey * 700) % 29000) * 0.5) / 100.0, TIMESTAMP '1995-01-01', NULL FROM part""",
    "src_products": """
        SELECT p_partkey AS id, p_partkey % 25 AS distribution_center_id, 'SKU' || p_partkey AS sku, p_name AS name,
               p_brand AS brand, p_type AS category, if(p_partkey % 2 = 0, 'Men', 'Women') AS department,
               (1099 + (p_partkey * 700) % 29000) / 100.0 AS retail_price,
               floor((1099 + (p_partkey * 700) % 29000) * 0.5) / 100.0 AS cost FROM part""",
    "src_centers": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_nationkey AS DOUBLE) AS latitude,
               CAST(2 * n_nationkey AS DOUBLE) AS longitude FROM nation""",
    "src_events": """
        SELECT event_id AS id, user_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
               event_id % 10 + 1 AS sequence_number, event_type,
               CASE event_id % 3 WHEN 0 THEN 'Search' WHEN 1 THEN 'Email' ELSE '' END AS traffic_source,
               'Chrome' AS browser, '/' || event_type AS uri, '' AS blank, ts AS created_at FROM events""",
    # cleaned
    "c_users": f"""
        SELECT id AS user_id, {_title('first_name')} AS first_name, {_title('last_name')} AS last_name,
               lower(trim(email)) AS email, age, {_band('age', fixed.AGE_BANDS)} AS age_band, gender, city, state,
               {_clean('postal_code')} AS postal_code, country, latitude, longitude, traffic_source,
               created_at AS registered_at, CAST(created_at AS DATE) AS registered_date
        FROM src_users WHERE {_IN_WINDOW}""",
    "c_orders": f"""
        SELECT order_id, user_id, status AS order_status, {_FLAGS}, num_of_item AS items_ordered, created_at AS ordered_at,
               CAST(created_at AS DATE) AS ordered_date, CAST(date_trunc('month', created_at) AS DATE) AS ordered_month,
               shipped_at, delivered_at, returned_at,
               date_diff('day', CAST(created_at AS DATE), CAST(shipped_at AS DATE)) AS days_to_ship,
               date_diff('day', CAST(shipped_at AS DATE), CAST(delivered_at AS DATE)) AS days_in_transit,
               date_diff('day', CAST(created_at AS DATE), CAST(delivered_at AS DATE)) AS days_to_deliver
        FROM src_orders WHERE {_IN_WINDOW}""",
    "c_items": f"""
        SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id, status AS item_status, {_FLAGS},
               CAST(sale_price AS DECIMAL(18,2)) AS sale_price, created_at AS ordered_at,
               CAST(created_at AS DATE) AS ordered_date, shipped_at, delivered_at, returned_at
        FROM src_items WHERE {_IN_WINDOW}""",
    "c_products": f"""
        SELECT id AS product_id, distribution_center_id, {_clean('sku')} AS sku, {_clean('name')} AS product_name,
               {_clean('brand')} AS brand, {_clean('category')} AS category, department,
               CAST(retail_price AS DECIMAL(18,2)) AS list_price, CAST(cost AS DECIMAL(18,2)) AS list_cost,
               CAST(retail_price AS DECIMAL(18,2)) - CAST(cost AS DECIMAL(18,2)) AS list_margin_amount,
               (retail_price - cost) / retail_price AS list_margin_pct FROM src_products""",
    "c_inventory": """
        SELECT id AS inventory_item_id, product_id, distribution_center_id, CAST(cost AS DECIMAL(18,2)) AS unit_cost,
               created_at AS stocked_at, sold_at, sold_at IS NOT NULL AS is_sold,
               date_diff('day', CAST(created_at AS DATE), CAST(sold_at AS DATE)) AS days_on_shelf FROM src_inventory""",
    "c_centers": """
        SELECT id AS distribution_center_id, trim(name) AS distribution_center_name, latitude, longitude
        FROM src_centers""",
    "c_events": f"""
        SELECT id AS event_id, user_id, session_id, sequence_number, event_type, {_clean('traffic_source')} AS traffic_source,
               browser, uri AS page_uri, {_clean('blank')} AS city, {_clean('blank')} AS state,
               {_clean('blank')} AS postal_code, created_at AS occurred_at, CAST(created_at AS DATE) AS occurred_date
        FROM src_events WHERE created_at BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '2024-12-31'""",
    # units and orders
    "units": f"""
        SELECT *, net_revenue - net_cogs AS net_gross_profit,
               {ratio('net_revenue - net_cogs', 'net_revenue', 9)} AS net_margin_pct
        FROM (SELECT i.*, p.product_name, p.brand, p.category, p.department, p.distribution_center_id, p.list_price,
                     sale_price AS gross_revenue, if(i.is_revenue_recognised, sale_price, 0::DECIMAL(18,2)) AS net_revenue,
                     if(i.is_revenue_recognised, coalesce(v.unit_cost, p.list_cost), 0::DECIMAL(18,2)) AS net_cogs,
                     if(i.is_returned, sale_price, 0::DECIMAL(18,2)) AS returned_revenue,
                     if(i.is_revenue_recognised, 1, 0) AS net_units, list_price - sale_price AS discount_amount
              FROM c_items i LEFT JOIN c_inventory v USING (inventory_item_id)
              LEFT JOIN c_products p ON p.product_id = i.product_id)""",
    "baskets": """
        SELECT order_id, count(*) AS line_items, sum(net_units) AS units_sold,
               count(DISTINCT product_id) AS distinct_products, count(DISTINCT category) AS distinct_categories,
               sum(gross_revenue) AS gross_revenue, sum(net_revenue) AS net_revenue, sum(net_cogs) AS net_cogs,
               sum(net_gross_profit) AS net_gross_profit, sum(returned_revenue) AS returned_revenue,
               sum(discount_amount) AS discount_amount, count(*) FILTER (is_returned) AS returned_items,
               count(*) FILTER (is_cancelled) AS cancelled_items,
               arg_max(category, (gross_revenue, category)) AS sample_category
        FROM units GROUP BY order_id""",
    "firsts": """
        SELECT user_id, min(ordered_at) AS first_purchase_at, max(ordered_at) AS latest_purchase_at,
               CAST(date_trunc('month', min(ordered_at)) AS DATE) AS cohort_month
        FROM c_orders WHERE is_revenue_recognised GROUP BY user_id""",
    "bought": """
        SELECT order_id, row_number() OVER (PARTITION BY user_id ORDER BY ordered_at, order_id) AS purchase_seq
        FROM c_orders WHERE is_revenue_recognised""",
    "timeline": """
        SELECT o.*, row_number() OVER (PARTITION BY o.user_id ORDER BY o.ordered_at, o.order_id) AS order_seq,
               b.purchase_seq, b.purchase_seq = 1 AS is_first_purchase, b.purchase_seq > 1 AS is_repeat_purchase,
               f.first_purchase_at, f.latest_purchase_at, f.cohort_month,
               date_diff('month', f.cohort_month, o.ordered_month) AS months_since_first_purchase
        FROM c_orders o LEFT JOIN bought b USING (order_id) LEFT JOIN firsts f ON f.user_id = o.user_id""",
    "gap": """
        SELECT min(ordered_date) AS first_incomplete_date FROM c_orders
        WHERE order_id NOT IN (SELECT order_id FROM c_items)""",
    "edge": """
        SELECT coalesce(first_incomplete_date - 1, (SELECT max(ordered_date) FROM c_orders)) - 3 AS complete_through
        FROM gap""",
    "m_orders": f"""
        SELECT t.*, b.* EXCLUDE (order_id), b.order_id IS NOT NULL AS has_line_items,
               t.ordered_date <= (SELECT complete_through FROM edge) AS is_revenue_complete,
               {ratio('b.net_gross_profit', 'b.net_revenue', 9)} AS net_margin_pct
        FROM timeline t LEFT JOIN baskets b ON b.order_id = t.order_id""",
    # customers and products
    "spend": """
        SELECT user_id, count(*) AS lifetime_orders_placed, count(*) FILTER (is_revenue_recognised) AS lifetime_orders,
               count(*) FILTER (is_cancelled) AS lifetime_cancelled_orders,
               count(*) FILTER (is_returned) AS lifetime_returned_orders,
               sum(net_revenue) FILTER (is_revenue_recognised) AS lifetime_net_revenue,
               sum(net_gross_profit) FILTER (is_revenue_recognised) AS lifetime_gross_profit,
               sum(units_sold) FILTER (is_revenue_recognised) AS lifetime_units,
               count(*) FILTER (is_revenue_recognised AND NOT is_revenue_complete) AS lifetime_incomplete_orders,
               count(*) FILTER (is_revenue_recognised AND NOT has_line_items) AS lifetime_orders_missing_economics,
               min(ordered_date) FILTER (is_revenue_recognised) AS first_order_date,
               max(ordered_date) FILTER (is_revenue_recognised) AS latest_order_date, min(cohort_month) AS cohort_month
        FROM m_orders GROUP BY user_id""",
    "m_customers": f"""
        SELECT *, CASE WHEN NOT has_purchased THEN 'Never purchased'
                       WHEN is_active THEN if(is_repeat_customer, 'Active - repeat', 'Active - new')
                       WHEN days_since_last_order <= 365 THEN 'Lapsing' ELSE 'Churned' END AS customer_status
        FROM (SELECT u.*, s.cohort_month, s.first_order_date, s.latest_order_date, as_of_date,
                     coalesce(s.lifetime_orders, 0) AS lifetime_orders,
                     coalesce(s.lifetime_orders_placed, 0) AS lifetime_orders_placed,
                     coalesce(s.lifetime_cancelled_orders, 0) AS lifetime_cancelled_orders,
                     coalesce(s.lifetime_returned_orders, 0) AS lifetime_returned_orders,
                     coalesce(s.lifetime_units, 0) AS lifetime_units,
                     coalesce(s.lifetime_net_revenue, 0) AS lifetime_net_revenue,
                     coalesce(s.lifetime_gross_profit, 0) AS lifetime_gross_profit,
                     {ratio('s.lifetime_net_revenue', 's.lifetime_orders', 2)} AS avg_order_value,
                     coalesce(s.lifetime_incomplete_orders, 0) AS lifetime_incomplete_orders,
                     coalesce(s.lifetime_incomplete_orders, 0) > 0 AS has_incomplete_orders,
                     coalesce(s.lifetime_orders_missing_economics, 0) AS lifetime_orders_missing_economics,
                     as_of_date - s.latest_order_date AS days_since_last_order,
                     s.latest_order_date - s.first_order_date AS customer_tenure_days,
                     as_of_date - s.latest_order_date <= 90 AS is_active,
                     coalesce(s.lifetime_orders, 0) > 0 AS has_purchased,
                     coalesce(s.lifetime_orders, 0) > 1 AS is_repeat_customer
              FROM c_users u LEFT JOIN spend s USING (user_id), (SELECT max(ordered_date) AS as_of_date FROM c_orders))""",
    "stock": f"""
        SELECT product_id, count(*) AS units_stocked, count(sold_at) AS units_sold_all_time,
               {ratio('sum(unit_cost)', 'count(unit_cost)', 2)} AS avg_unit_cost,
               {ratio('sum(days_on_shelf)', 'count(days_on_shelf)', 1)} AS avg_days_on_shelf
        FROM c_inventory GROUP BY product_id""",
    "m_products": f"""
        SELECT p.*, c.distribution_center_name, s.* EXCLUDE (product_id),
               {ratio('units_sold_all_time', 'units_stocked', 4)} AS sell_through_rate,
               {_band('p.list_price', fixed.PRICE_TIERS)} AS price_tier
        FROM c_products p LEFT JOIN c_centers c USING (distribution_center_id)
        LEFT JOIN stock s ON s.product_id = p.product_id""",
    # days
    "days_with_orders": """
        SELECT ordered_date AS revenue_date, count(*) AS orders_placed, count(*) FILTER (is_revenue_recognised) AS orders,
               count(*) FILTER (is_cancelled) AS cancelled_orders, count(*) FILTER (is_returned) AS returned_orders,
               count(*) FILTER (is_first_purchase) AS new_customer_orders,
               count(*) FILTER (is_repeat_purchase) AS repeat_customer_orders, count(DISTINCT user_id) AS customers,
               sum(units_sold) AS units_sold, sum(net_revenue) AS net_revenue, sum(net_cogs) AS net_cogs,
               sum(net_gross_profit) AS net_gross_profit, sum(returned_revenue) AS returned_revenue,
               sum(discount_amount) AS discount_amount, bool_or(is_revenue_complete) AS any_complete
        FROM m_orders GROUP BY 1""",
    "order_days": """
        SELECT CAST(unnest(generate_series(min(ordered_date), max(ordered_date), INTERVAL 1 DAY)) AS DATE) AS revenue_date
        FROM c_orders""",
    "m_days": f"""
        SELECT s.revenue_date,
               s.revenue_date <= (SELECT max(ordered_date) FROM m_orders WHERE is_revenue_complete) AS is_revenue_complete,
               CAST(date_trunc('week', s.revenue_date) AS DATE) AS revenue_week,
               CAST(date_trunc('month', s.revenue_date) AS DATE) AS revenue_month,
               CAST(date_trunc('quarter', s.revenue_date) AS DATE) AS revenue_quarter,
               dayname(s.revenue_date) AS day_name, isodow(s.revenue_date) >= 6 AS is_weekend,
               coalesce(orders_placed, 0) AS orders_placed, coalesce(orders, 0) AS orders,
               coalesce(cancelled_orders, 0) AS cancelled_orders, coalesce(returned_orders, 0) AS returned_orders,
               coalesce(new_customer_orders, 0) AS new_customer_orders,
               coalesce(repeat_customer_orders, 0) AS repeat_customer_orders, coalesce(customers, 0) AS customers,
               coalesce(units_sold, 0) AS units_sold, coalesce(net_revenue, 0) AS net_revenue,
               coalesce(net_cogs, 0) AS net_cogs, coalesce(net_gross_profit, 0) AS net_gross_profit,
               coalesce(returned_revenue, 0) AS returned_revenue, coalesce(discount_amount, 0) AS discount_amount,
               {ratio('net_revenue', 'orders', 2)} AS avg_order_value,
               {ratio('net_gross_profit', 'net_revenue', 4)} AS gross_margin_pct,
               {ratio('cancelled_orders', 'orders_placed', 4)} AS cancellation_rate,
               {ratio('returned_orders', 'orders_placed', 4)} AS return_rate
        FROM order_days s LEFT JOIN days_with_orders d ON d.revenue_date = s.revenue_date""",
    "week_sums": """
        SELECT a.revenue_date, sum(b.net_revenue) AS total, count(*) AS days FROM m_days a
        JOIN m_days b ON b.revenue_date BETWEEN a.revenue_date - 6 AND a.revenue_date GROUP BY 1""",
    "m_daily": f"""
        SELECT d.*, {ratio('w.total', 'w.days', 2)} AS net_revenue_7d_avg, y.net_revenue AS net_revenue_ly
        FROM m_days d JOIN week_sums w USING (revenue_date)
        LEFT JOIN m_days y ON y.revenue_date = d.revenue_date - 364""",
    "usual_volume": """
        SELECT a.revenue_date, any_value(a.is_revenue_complete) AS is_revenue_complete,
               any_value(a.orders_placed) AS orders_placed,
               CAST(sum(b.orders_placed) AS DOUBLE) / count(b.orders_placed) AS trailing_avg_orders
        FROM m_days a LEFT JOIN m_days b ON b.revenue_date BETWEEN a.revenue_date - 28 AND a.revenue_date - 1
        GROUP BY a.revenue_date""",
    # products by month
    "product_months": """
        SELECT CAST(date_trunc('month', ordered_date) AS DATE) AS revenue_month, product_id, count(*) AS line_items,
               sum(net_units) AS units_sold, count(*) FILTER (is_returned) AS units_returned,
               count(DISTINCT user_id) AS customers, sum(net_revenue) AS net_revenue, sum(net_cogs) AS net_cogs,
               sum(net_gross_profit) AS net_gross_profit, sum(discount_amount) AS discount_amount
        FROM units GROUP BY ALL""",
    "sold_products": f"""
        SELECT m.*, p.sku, p.product_name, p.brand, p.category, p.department, p.price_tier, p.distribution_center_name,
               {ratio('m.net_gross_profit', 'm.net_revenue', 4)} AS gross_margin_pct,
               {ratio('m.units_returned', 'm.line_items', 4)} AS return_rate,
               {ratio('m.net_revenue', 'm.units_sold', 2)} AS avg_selling_price
        FROM product_months m LEFT JOIN m_products p USING (product_id)""",
    "m_performance": f"""
        SELECT *, row_number() OVER (PARTITION BY revenue_month, category ORDER BY net_revenue DESC, product_id)
                      AS revenue_rank_in_category,
               {ratio('net_revenue', 'month_total', 6)} AS pct_of_month_revenue
        FROM (SELECT *, sum(net_revenue) OVER (PARTITION BY revenue_month) AS month_total FROM sold_products)""",
    # cohorts, channels, concentration
    "cohort_months": """
        SELECT cohort_month, months_since_first_purchase, count(DISTINCT user_id) AS active_customers,
               count(DISTINCT order_id) AS orders, sum(net_revenue) AS net_revenue,
               sum(net_gross_profit) AS net_gross_profit,
               count(DISTINCT user_id) FILTER (is_first_purchase) AS first_purchases
        FROM m_orders WHERE is_revenue_recognised AND cohort_month IS NOT NULL GROUP BY 1, 2""",
    "cohort_spans": """
        SELECT f.cohort_month, count(DISTINCT f.user_id) AS cohort_customers,
               max(months_since_first_purchase) AS max_offset
        FROM firsts f JOIN cohort_months m ON m.cohort_month = f.cohort_month GROUP BY 1""",
    "cohort_cells": """
        SELECT cohort_month, cohort_customers, unnest(range(0, max_offset + 1)) AS months_since_first_purchase
        FROM cohort_spans""",
    "data_cells": """
        SELECT cohort_month, cohort_customers, unnest(range(0, date_diff('month', cohort_month, last_month) + 1))
                   AS months_since_first_purchase
        FROM cohort_spans, (SELECT max(ordered_month) AS last_month FROM c_orders WHERE is_revenue_recognised)""",
    "m_channels": f"""
        SELECT CAST(date_trunc('month', registered_date) AS DATE) AS registration_month, traffic_source,
               count(*) AS customers_acquired, count(*) FILTER (has_purchased) AS customers_who_purchased,
               count(*) FILTER (is_repeat_customer) AS repeat_customers,
               count(*) FILTER (is_active) AS still_active_customers, sum(lifetime_orders) AS lifetime_orders,
               sum(lifetime_net_revenue) AS lifetime_net_revenue, sum(lifetime_gross_profit) AS lifetime_gross_profit,
               {ratio('count(*) FILTER (has_purchased)', 'count(*)', 4)} AS conversion_rate,
               {ratio('count(*) FILTER (is_repeat_customer)', 'count(*) FILTER (has_purchased)', 4)} AS repeat_rate,
               {ratio('sum(lifetime_net_revenue)', 'count(*)', 2)} AS revenue_per_acquired_customer,
               {ratio('sum(lifetime_net_revenue)', 'count(*) FILTER (has_purchased)', 2)}
                   AS revenue_per_purchasing_customer,
               {ratio('sum(lifetime_orders)', 'count(*) FILTER (has_purchased)', 2)} AS orders_per_purchasing_customer
        FROM m_customers GROUP BY 1, 2""",
    "tiles": """
        SELECT user_id, lifetime_net_revenue,
               ntile(10) OVER (ORDER BY lifetime_net_revenue DESC, user_id) AS revenue_decile
        FROM m_customers WHERE has_purchased""",
}


def _cohort_table(cells: str) -> str:
    return f"""
        SELECT c.*, coalesce(a.active_customers, 0) AS active_customers, coalesce(a.orders, 0) AS orders,
               coalesce(a.net_revenue, 0) AS net_revenue, coalesce(a.net_gross_profit, 0) AS net_gross_profit,
               {ratio('a.active_customers', 'c.cohort_customers', 4)} AS retention_rate,
               {ratio('a.net_revenue', 'c.cohort_customers', 2)} AS revenue_per_cohort_customer,
               {ratio('''(SELECT sum(e.net_revenue) FROM cohort_months e WHERE e.cohort_month = c.cohort_month
                          AND e.months_since_first_purchase <= c.months_since_first_purchase)''',
                      'c.cohort_customers', 2)} AS cumulative_ltv
        FROM {cells} c LEFT JOIN cohort_months a ON a.cohort_month = c.cohort_month
             AND a.months_since_first_purchase = c.months_since_first_purchase"""


RELATIONS["m_cohorts"] = _cohort_table("cohort_cells")
RELATIONS["m_cohorts_to_end"] = _cohort_table("data_cells")

_TYPES = {
    "BIGINT": """age order_id user_id product_id inventory_item_id order_item_id distribution_center_id event_id id
        sequence_number items_ordered days_to_ship days_in_transit days_to_deliver days_on_shelf net_units line_items
        units_sold distinct_products distinct_categories returned_items cancelled_items order_seq purchase_seq
        months_since_first_purchase lifetime_orders lifetime_orders_placed lifetime_cancelled_orders
        lifetime_returned_orders lifetime_units lifetime_incomplete_orders lifetime_orders_missing_economics
        days_since_last_order customer_tenure_days units_stocked units_sold_all_time orders_placed orders
        cancelled_orders returned_orders new_customer_orders repeat_customer_orders customers units_returned
        revenue_rank_in_category cohort_customers active_customers customers_acquired customers_who_purchased
        repeat_customers still_active_customers revenue_decile first_purchases max_offset n_rows recognised cancelled
        returned recognised_items orders_total decile products past_events window_days failures age_hours key
        order_count cancelled_order_measure repeat_orders purchasing_customers
        registered_customers purchasing_customers_lifetime active_customers_metric item_units_measure
        returned_units_measure line_item_measure l_orderkey l_linenumber""",
    "DOUBLE": """latitude longitude sale_price list_price list_cost list_margin_amount list_margin_pct unit_cost
        gross_revenue net_revenue net_cogs net_gross_profit net_margin_pct returned_revenue discount_amount
        lifetime_net_revenue lifetime_gross_profit avg_order_value avg_unit_cost avg_days_on_shelf sell_through_rate
        gross_margin_pct cancellation_rate return_rate net_revenue_7d_avg net_revenue_ly avg_selling_price
        pct_of_month_revenue retention_rate revenue_per_cohort_customer cumulative_ltv conversion_rate repeat_rate
        revenue_per_acquired_customer revenue_per_purchasing_customer orders_per_purchasing_customer revenue
        pct_of_total_revenue avg_ltv share trailing_avg_orders ratio order_revenue line_item_revenue difference
        list_value cost unit_revenue margin returned_share off_list average_order_value gross_profit
        repeat_purchase_rate repeat_customer_rate lifetime_revenue lifetime_value_per_customer
        net_revenue_mom_growth cogs_measure item_revenue_measure""",
    "DATE": """ordered_date ordered_month registered_date occurred_date cohort_month first_order_date
        latest_order_date as_of_date revenue_date revenue_week revenue_month revenue_quarter registration_month
        first_incomplete_date complete_through max_order_date last_seen start_date end_date day date_day date_week
        date_month date_quarter date_year month quarter year week week_monday week_sunday settled_date
        partition_month metric_time metric_time__month metric_time__quarter metric_time__week""",
}
TYPE_OF = {column: kind for kind, columns in _TYPES.items() for column in columns.split()}


def _with_relations(body: str, **replaced: str) -> str:
    """Prefix a SELECT with the CTEs it needs, in definition order."""
    relations = RELATIONS | replaced
    used: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\b[a-z_]+\b", pending.pop()))
        for name in words & relations.keys() - used:
            used.add(name)
            pending.append(relations[name])
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in relations.items() if name in used)
    return f"WITH {ctes} {body}" if ctes else body


def _out(columns: str | list[str], source: str, **replaced: str) -> str:
    """SELECT of ``columns``, each cast to its plain type, from a relation or SELECT;
    ``replaced`` swaps relations underneath it."""
    names = columns.split() if isinstance(columns, str) else columns
    cast = ", ".join(f"CAST({n} AS {TYPE_OF[n]}) AS {n}" if n in TYPE_OF else n for n in names)
    origin = f"({source})" if source.lstrip().upper().startswith("SELECT") else source
    return _with_relations(f"SELECT {cast} FROM {origin}", **replaced)


ORDER_STAGE = (
    "order_id user_id order_status is_revenue_recognised is_cancelled is_returned items_ordered ordered_at "
    "ordered_date ordered_month shipped_at delivered_at returned_at days_to_ship days_in_transit days_to_deliver"
)
ITEM_STAGE = (
    "order_item_id order_id user_id product_id inventory_item_id item_status is_revenue_recognised is_cancelled "
    "is_returned sale_price ordered_at ordered_date shipped_at delivered_at returned_at"
)
PRODUCT_STAGE = (
    "product_id distribution_center_id sku product_name brand category department list_price list_cost "
    "list_margin_amount list_margin_pct"
)
CUSTOMER_COLUMNS = (
    "user_id first_name last_name email age age_band gender city state postal_code country traffic_source "
    "registered_date cohort_month lifetime_orders lifetime_orders_placed lifetime_cancelled_orders "
    "lifetime_returned_orders lifetime_units lifetime_net_revenue lifetime_gross_profit avg_order_value "
    "lifetime_incomplete_orders has_incomplete_orders lifetime_orders_missing_economics first_order_date "
    "latest_order_date days_since_last_order customer_tenure_days has_purchased is_repeat_customer is_active "
    "customer_status as_of_date"
)
SPEND_COLUMNS = (
    "user_id lifetime_orders_placed lifetime_orders lifetime_cancelled_orders lifetime_returned_orders "
    "lifetime_net_revenue lifetime_gross_profit lifetime_units lifetime_incomplete_orders "
    "lifetime_orders_missing_economics first_order_date latest_order_date cohort_month"
)
DIM_PRODUCT_COLUMNS = (
    "product_id sku product_name brand category department distribution_center_id distribution_center_name "
    "list_price list_cost list_margin_amount list_margin_pct avg_unit_cost units_stocked units_sold_all_time "
    "avg_days_on_shelf sell_through_rate price_tier"
)
STOCK_COLUMNS = "product_id units_stocked units_sold_all_time avg_unit_cost avg_days_on_shelf"
DAY_COLUMNS = (
    "revenue_date orders_placed orders cancelled_orders returned_orders new_customer_orders repeat_customer_orders "
    "customers units_sold net_revenue net_cogs net_gross_profit returned_revenue discount_amount"
)
DAILY_COLUMNS = (
    "is_revenue_complete revenue_week revenue_month revenue_quarter day_name is_weekend " + DAY_COLUMNS + " "
    "avg_order_value gross_margin_pct cancellation_rate return_rate net_revenue_7d_avg net_revenue_ly"
)
PRODUCT_MONTH_COLUMNS = (
    "revenue_month product_id line_items units_sold units_returned customers net_revenue net_cogs "
    "net_gross_profit discount_amount"
)
SOLD_PRODUCT_COLUMNS = PRODUCT_MONTH_COLUMNS + (
    " sku product_name brand category department price_tier distribution_center_name gross_margin_pct return_rate "
    "avg_selling_price"
)
COHORT_COLUMNS = (
    "cohort_month months_since_first_purchase cohort_customers active_customers orders net_revenue net_gross_profit "
    "retention_rate revenue_per_cohort_customer cumulative_ltv"
)
CHANNEL_TOTALS = [
    "registration_month", "traffic_source", "customers_acquired", "customers_who_purchased", "repeat_customers",
    "still_active_customers", "lifetime_orders", "lifetime_net_revenue", "lifetime_gross_profit",
]
CHANNEL_COLUMNS = [
    *CHANNEL_TOTALS, "conversion_rate", "repeat_rate", "revenue_per_acquired_customer",
    "revenue_per_purchasing_customer", "orders_per_purchasing_customer",
]
BASKET_COLUMNS = (
    "order_id line_items units_sold distinct_products distinct_categories gross_revenue net_revenue net_cogs "
    "net_gross_profit returned_revenue discount_amount returned_items cancelled_items sample_category"
)
HISTORY_COLUMNS = (
    "order_id user_id order_status is_revenue_recognised is_returned is_cancelled ordered_at ordered_date "
    "ordered_month net_revenue net_gross_profit units_sold order_seq purchase_seq first_purchase_at "
    "latest_purchase_at is_first_purchase is_repeat_purchase cohort_month months_since_first_purchase"
)

_SOURCES = {
    "users": "src_users",
    "orders": "src_orders",
    "order_items": "src_items",
    "products": "src_products",
    "inventory_items": "src_inventory",
    "distribution_centers": "src_centers",
    "events": "src_events",
}

_RAW_WINDOW = f"""
    SELECT max_order_date, complete_through, max_order_date - complete_through AS window_days
    FROM (SELECT max(d) AS max_order_date, max(d) FILTER (d <= first_gap - 4) AS complete_through
          FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
                WHERE o_orderdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '2001-08-01'),
               (SELECT CAST(min(o_orderdate) AS DATE) AS first_gap FROM orders
                WHERE o_orderdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '2001-08-01'
                  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)))
    WHERE complete_through IS NULL OR max_order_date - complete_through > 14"""

_REFERENCES = [
    ("source.orders", "user_id", "src_orders", "src_users", "id"),
    ("source.order_items", "order_id", "src_items", "src_orders", "order_id"),
    ("source.order_items", "product_id", "src_items", "src_products", "id"),
    ("orders", "user_id", "c_orders", "c_users", "user_id"),
    ("order_items", "order_id", "c_items", "c_orders", "order_id"),
    ("order_items", "product_id", "c_items", "c_products", "product_id"),
    ("order_items", "inventory_item_id", "c_items", "c_inventory", "inventory_item_id"),
    ("inventory_items", "product_id", "c_inventory", "c_products", "product_id"),
    ("fct_orders", "user_id", "m_orders", "m_customers", "user_id"),
    ("fct_order_items", "order_id", "units", "m_orders", "order_id"),
    ("fct_order_items", "product_id", "units", "m_products", "product_id"),
    ("orders", "order_id", "c_orders", "c_items", "order_id"),
]

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_scan": _out(
        "table_name n_rows",
        "SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {r}" for t, r in _SOURCES.items())
        + ")",
    ),
    "src_freshness": _out(
        "table_name max_loaded_at age_hours status",
        "SELECT table_name, max_loaded_at, floor(epoch(TIMESTAMP '2001-08-02 12:00:00' - max_loaded_at) / 3600) AS "
        "age_hours, CASE WHEN max_loaded_at < TIMESTAMP '2001-07-30 12:00:00' THEN 'error' "
        "WHEN max_loaded_at < TIMESTAMP '2001-08-01 12:00:00' THEN 'warn' ELSE 'pass' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, max({'created_at' }) AS max_loaded_at FROM {r}"
            for t, r in _SOURCES.items()
            if t not in ("products", "distribution_centers")
        )
        + ")",
    ),
    "sink_table": _out(CHANNEL_COLUMNS, "m_channels"),
    "sink_month_partitioned": _out(
        "order_id order_status user_id ordered_date partition_month net_revenue",
        "SELECT *, ordered_month AS partition_month FROM m_orders",
    ),
    "sink_clustered": _out(DIM_PRODUCT_COLUMNS, "m_products"),
    # staging
    "stg_users": _out(
        "user_id first_name last_name email age age_band gender city state postal_code country latitude longitude "
        "traffic_source registered_at registered_date",
        "c_users",
    ),
    "stg_orders": _out(ORDER_STAGE, "c_orders"),
    "stg_order_items": _out(ITEM_STAGE, "c_items"),
    "stg_products": _out(PRODUCT_STAGE, "c_products"),
    "stg_inventory_items": _out(
        "inventory_item_id product_id distribution_center_id unit_cost stocked_at sold_at is_sold days_on_shelf",
        "c_inventory",
    ),
    "stg_distribution_centers": _out("distribution_center_id distribution_center_name latitude longitude", "c_centers"),
    "stg_events": _out(
        "event_id user_id session_id sequence_number event_type traffic_source browser page_uri city state "
        "postal_code occurred_at occurred_date",
        "c_events",
    ),
    "flt_time_clamp": _out(
        "order_id created_at",
        "SELECT * FROM src_orders WHERE created_at >= TIMESTAMP '1994-01-01' AND NOT created_at > TIMESTAMP '2000-12-31'",
    ),
    "prj_status_flags": _out(
        "id status is_revenue_recognised is_cancelled is_returned", f"SELECT id, status, {_FLAGS} FROM src_items"
    ),
    "prj_age_band": _out(
        "id age age_band", f"SELECT id, age, {_band('age', fixed.AGE_BANDS)} AS age_band FROM src_users"
    ),
    "prj_price_tier": _out("product_id list_price price_tier", "m_products"),
    "prj_customer_status": _out("user_id lifetime_orders days_since_last_order customer_status", "m_customers"),
    "prj_net_gross_split": _out(
        "order_item_id gross_revenue net_revenue net_cogs returned_revenue net_units discount_amount", "units"
    ),
    "prj_margin": _out("order_item_id net_gross_profit net_margin_pct", "units"),
    "prj_purchase_flags": _out("order_id purchase_seq is_first_purchase is_repeat_purchase", "timeline"),
    "flt_has_purchased": _out("user_id lifetime_net_revenue", "SELECT * FROM m_customers WHERE lifetime_orders >= 1"),
    "flt_recognised_with_cohort": _out(
        "order_id user_id cohort_month months_since_first_purchase", "SELECT * FROM timeline WHERE purchase_seq >= 1"
    ),
    # joins
    "join_items_inventory": _out(
        "order_item_id inventory_item_id unit_cost", "SELECT * FROM c_items LEFT JOIN c_inventory USING (inventory_item_id)"
    ),
    "join_items_products": _out(
        "order_item_id product_id product_name brand category department list_price list_cost",
        "SELECT * FROM c_items LEFT JOIN c_products USING (product_id)",
    ),
    "join_orders_economics": _out("order_id user_id line_items units_sold net_revenue net_gross_profit", "m_orders"),
    "join_orders_history": _out(
        "order_id order_seq purchase_seq is_first_purchase is_repeat_purchase cohort_month "
        "months_since_first_purchase line_items net_revenue",
        "m_orders",
    ),
    "anti_first_gap": _out("first_incomplete_date", "gap"),
    "cross_completeness": _out(
        "order_id ordered_date complete_through is_revenue_complete",
        "SELECT order_id, ordered_date, complete_through, NOT ordered_date > complete_through AS is_revenue_complete "
        "FROM c_orders CROSS JOIN edge",
    ),
    "cross_asof": _out(
        "user_id registered_date as_of_date",
        "SELECT user_id, registered_date, (SELECT max(ordered_date) FROM c_orders) AS as_of_date FROM c_users",
    ),
    "join_customers_orders": _out(SPEND_COLUMNS, "SELECT * FROM c_users LEFT JOIN spend USING (user_id)"),
    "join_products_centers": _out("product_id distribution_center_id distribution_center_name", "m_products"),
    "join_products_inventory_agg": _out(
        "product_id list_cost units_stocked units_sold_all_time avg_unit_cost avg_days_on_shelf", "m_products"
    ),
    "join_spine_daily": _out(
        "revenue_date orders_placed",
        "SELECT d.revenue_date, (SELECT count(*) FROM c_orders WHERE ordered_date = d.revenue_date) AS orders_placed "
        "FROM order_days d",
    ),
    "join_perf_products": _out(SOLD_PRODUCT_COLUMNS, "sold_products"),
    "join_cohort_size_period": _out("cohort_month cohort_customers max_offset", "cohort_spans"),
    "join_grid_activity": _out(
        "cohort_month months_since_first_purchase cohort_customers active_customers orders",
        "SELECT * FROM cohort_cells LEFT JOIN cohort_months USING (cohort_month, months_since_first_purchase)",
    ),
    "join_reconcile": _out(
        "order_id order_revenue line_item_revenue difference",
        "SELECT order_id, o.net_revenue AS order_revenue, i.total AS line_item_revenue, "
        "abs(o.net_revenue - i.total) AS difference FROM m_orders o JOIN (SELECT order_id, "
        "sum(CASE WHEN item_status NOT IN ('Cancelled', 'Returned') THEN sale_price ELSE 0 END) AS total "
        "FROM c_items GROUP BY 1) i USING (order_id)",
    ),
    "scalar_subquery": _out(
        "first_incomplete_date max_order_date last_seen",
        "SELECT *, coalesce(first_incomplete_date, max_order_date) AS last_seen "
        "FROM gap, (SELECT max(ordered_date) AS max_order_date FROM c_orders)",
    ),
    "lateral_unnest": _out(
        "order_id day",
        "SELECT order_id, unnest(generate_series(ordered_date, CAST(delivered_at AS DATE), INTERVAL 1 DAY)) AS day "
        "FROM c_orders WHERE delivered_at IS NOT NULL",
    ),
    "semi_fk": _out(
        "table_name column_name key n_rows",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, {c} AS key, count(*) AS n_rows FROM {child} "
            f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM {parent}) GROUP BY {c}"
            for t, c, child, parent, pk in _REFERENCES
        )
        + ")",
    ),
    # aggregations
    "orders_aggregated": _out(BASKET_COLUMNS, "baskets"),
    "customer_orders": _out(SPEND_COLUMNS, "spend"),
    "inventory_by_product": _out(STOCK_COLUMNS, "stock"),
    "daily_orders": _out(DAY_COLUMNS + " any_complete", "days_with_orders"),
    "product_month": _out(PRODUCT_MONTH_COLUMNS, "product_months"),
    "channel_month": _out(CHANNEL_TOTALS, "m_channels"),
    "cohort_sizes": _out("cohort_month cohort_customers", "cohort_spans"),
    "cohort_max_offset": _out("cohort_month max_offset", "cohort_spans"),
    "cohort_activity": _out(
        "cohort_month months_since_first_purchase active_customers orders net_revenue net_gross_profit first_purchases",
        "cohort_months",
    ),
    "global_minmax": _out(
        "start_date end_date", "SELECT min(ordered_date) AS start_date, max(ordered_date) AS end_date FROM c_orders"
    ),
    "complete_through_day": _out(
        "complete_through",
        "SELECT max(ordered_date) AS complete_through FROM c_orders WHERE ordered_date <= (SELECT complete_through FROM edge)",
    ),
    "order_item_revenue": _out("order_id net_revenue", "baskets"),
    "agg_countif": _out(
        "ordered_month recognised cancelled returned",
        "SELECT ordered_month, count(*) FILTER (is_revenue_recognised) AS recognised, "
        "count(*) FILTER (is_cancelled) AS cancelled, count(*) FILTER (is_returned) AS returned FROM c_orders GROUP BY 1",
    ),
    "agg_count_distinct": _out(
        "ordered_month customers",
        "SELECT ordered_month, count(*) AS customers FROM (SELECT DISTINCT ordered_month, user_id FROM c_orders) GROUP BY 1",
    ),
    "agg_cond_sum_minmax": _out(
        "user_id recognised_items first_order_date latest_order_date",
        "SELECT user_id, sum(items_ordered) FILTER (is_revenue_recognised) AS recognised_items, "
        "min(ordered_date) FILTER (is_revenue_recognised) AS first_order_date, "
        "max(ordered_date) FILTER (is_revenue_recognised) AS latest_order_date FROM c_orders GROUP BY 1",
    ),
    "agg_any_value": _out("order_id sample_category", "baskets"),
    "agg_of_agg_window": _out(
        "price_tier revenue share",
        f"SELECT price_tier, revenue, {ratio('revenue', 'total', 4)} AS share FROM "
        f"(SELECT {_band('list_price', fixed.PRICE_TIERS)} AS price_tier, sum(net_revenue) AS revenue FROM units GROUP BY 1), "
        "(SELECT sum(net_revenue) AS total FROM units)",
    ),
    # windows
    "win_order_seq": _out(
        "order_id user_id order_seq",
        "SELECT a.order_id, any_value(a.user_id) AS user_id, count(*) AS order_seq FROM c_orders a JOIN c_orders b "
        "ON a.user_id = b.user_id AND (b.ordered_at, b.order_id) <= (a.ordered_at, a.order_id) GROUP BY a.order_id",
    ),
    "win_purchase_seq": _out("order_id user_id purchase_seq", "timeline"),
    "win_first_purchase": _out("order_id first_purchase_at", "timeline"),
    "win_latest_purchase": _out("order_id latest_purchase_at", "timeline"),
    "win_trailing_7d": _out("revenue_date net_revenue net_revenue_7d_avg", "m_daily"),
    "win_lag_364": _out("revenue_date net_revenue net_revenue_ly", "m_daily"),
    "win_rank_in_category": _out(
        "revenue_month category product_id net_revenue revenue_rank_in_category", "m_performance"
    ),
    "win_share_of_month": _out("revenue_month product_id net_revenue pct_of_month_revenue", "m_performance"),
    "win_cumulative_ltv": _out("cohort_month months_since_first_purchase net_revenue cumulative_ltv", "m_cohorts"),
    "win_ntile10": _out("user_id lifetime_net_revenue revenue_decile", "tiles"),
    "win_trailing_28d_excl": _out(
        "revenue_date is_revenue_complete orders_placed trailing_avg_orders",
        "SELECT * REPLACE (round(trailing_avg_orders, 4) AS trailing_avg_orders) FROM usual_volume",
    ),
    "win_total": _out(
        "ordered_month orders_placed orders_total",
        "SELECT ordered_month, count(*) AS orders_placed, (SELECT count(*) FROM c_orders) AS orders_total "
        "FROM c_orders GROUP BY 1",
    ),
    # sorting
    "sort_deciles": _out(
        "decile products list_value",
        "SELECT decile, count(*) AS products, sum(list_price) AS list_value FROM (SELECT list_price, "
        "ntile(10) OVER (ORDER BY list_price DESC, product_id) AS decile FROM c_products) GROUP BY 1 ORDER BY 1",
    ),
    "topk_products": _out(
        "revenue_month category product_id net_revenue revenue_rank_in_category",
        "SELECT * FROM m_performance WHERE revenue_rank_in_category < 4",
    ),
    # scalar functions
    "fn_blank_to_null": _out(
        "id postal_code first_name",
        f"SELECT id, {_clean('postal_code')} AS postal_code, {_clean('first_name')} AS first_name FROM src_users",
    ),
    "fn_title_case": _out(
        "id name",
        f"SELECT * FROM (SELECT id, {_title('name')} AS name FROM src_products "
        f"UNION ALL SELECT id, {_title('email')} FROM src_users)",
    ),
    "fn_lower_email": _out("id email", "SELECT id, lower(trim(email)) AS email FROM src_users"),
    "fn_money": _out(
        "id cost",
        "SELECT id, CAST(round(CAST(cost * 1.0375::DOUBLE AS DECIMAL(38,9)), 2) AS DECIMAL(18,2)) AS cost FROM src_inventory",
    ),
    "fn_net_revenue": _out(
        "id net_revenue",
        "SELECT id, CASE WHEN status IN ('Cancelled', 'Returned') THEN 0 ELSE CAST(sale_price AS DECIMAL(18,2)) END "
        "AS net_revenue FROM src_items",
    ),
    "fn_safe_ratio": _out(
        "order_id unit_revenue margin returned_share",
        f"SELECT order_id, {ratio('net_revenue', 'units_sold', 2)} AS unit_revenue, "
        f"{ratio('net_gross_profit', 'net_revenue', 4)} AS margin, "
        f"{ratio('returned_items', 'line_items', 6)} AS returned_share FROM baskets",
    ),
    "fn_round": _out("product_id avg_unit_cost avg_days_on_shelf", "stock"),
    "fn_date_of_ts": _out("id day", "SELECT id, created_at AS day FROM src_events"),
    "fn_day_diff": _out("order_id days_to_ship days_in_transit days_to_deliver", "c_orders"),
    "fn_month_diff": _out("order_id months_since_first_purchase", "timeline"),
    "fn_date_trunc": _out(
        "order_id month quarter year",
        "SELECT order_id, date_trunc('month', ordered_date) AS month, date_trunc('quarter', ordered_date) AS quarter, "
        "date_trunc('year', ordered_date) AS year FROM c_orders",
    ),
    "fn_week_monday": _out(
        "order_id week", "SELECT order_id, ordered_date - CAST(isodow(ordered_date) - 1 AS INT) AS week FROM c_orders"
    ),
    "fn_week_default": _out(
        "order_id week_monday week_sunday",
        "SELECT order_id, ordered_date - CAST(isodow(ordered_date) - 1 AS INT) AS week_monday, "
        "ordered_date - CAST(dayofweek(ordered_date) AS INT) AS week_sunday FROM c_orders",
    ),
    "fn_day_name": _out("order_id day_name", "SELECT order_id, strftime(ordered_date, '%A') AS day_name FROM c_orders"),
    "fn_is_weekend": _out(
        "order_id is_weekend",
        "SELECT order_id, strftime(ordered_date, '%A') IN ('Saturday', 'Sunday') AS is_weekend FROM c_orders",
    ),
    "fn_date_sub": _out("order_id settled_date", "SELECT order_id, ordered_date - 3 AS settled_date FROM c_orders"),
    "fn_bool_to_int": _out("order_item_id net_units", "units"),
    "fn_coalesce_zero": _out("user_id lifetime_orders lifetime_net_revenue", "m_customers"),
    "fn_abs": _out("order_item_id off_list", "SELECT order_item_id, abs(discount_amount) AS off_list FROM units"),
    "fn_current_ts": _out(
        "past_events",
        "SELECT count(*) AS past_events FROM src_events WHERE created_at BETWEEN TIMESTAMP '1994-01-01' AND "
        "CAST(current_timestamp AS TIMESTAMP)",
    ),
    # generators
    "time_spine": _out(
        "date_day date_week date_month date_quarter date_year",
        "SELECT d AS date_day, date_trunc('week', d) AS date_week, date_trunc('month', d) AS date_month, "
        "date_trunc('quarter', d) AS date_quarter, date_trunc('year', d) AS date_year FROM (SELECT "
        "unnest(generate_series(TIMESTAMP '1994-01-01', CAST(max(ordered_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS d "
        "FROM c_orders)",
    ),
    "gen_data_spine": _out("revenue_date", "order_days"),
    "gen_cohort_grid": _out("cohort_month cohort_customers months_since_first_purchase", "cohort_cells"),
    # models
    "int_order_items_enriched": _out(ITEM_COLUMNS, "units"),
    "int_customer_order_history": _out(HISTORY_COLUMNS, "m_orders"),
    "completeness_boundary": _out("complete_through", "edge"),
    "fct_orders": _out(ORDER_COLUMNS, "m_orders"),
    "fct_order_items": _out(ITEM_COLUMNS, "units"),
    "dim_customers": _out(CUSTOMER_COLUMNS, "m_customers"),
    "dim_products": _out(DIM_PRODUCT_COLUMNS, "m_products"),
    "fct_daily_revenue": _out(DAILY_COLUMNS, "m_daily"),
    "mart_product_performance": _out(
        SOLD_PRODUCT_COLUMNS + " revenue_rank_in_category pct_of_month_revenue", "m_performance"
    ),
    "mart_customer_cohorts": _out(COHORT_COLUMNS, "m_cohorts"),
    "mart_customer_cohorts_to_data_end": _out(COHORT_COLUMNS, "m_cohorts_to_end"),
    "mart_acquisition_channels": _out(CHANNEL_COLUMNS, "m_channels"),
    "revenue_concentration": _out(
        "revenue_decile customers revenue pct_of_total_revenue avg_ltv",
        f"SELECT revenue_decile, customers, revenue, {ratio('revenue', 'total', 4)} AS pct_of_total_revenue, "
        f"{ratio('revenue', 'customers', 2)} AS avg_ltv FROM (SELECT revenue_decile, count(*) AS customers, "
        "sum(lifetime_net_revenue) AS revenue FROM tiles GROUP BY 1), "
        "(SELECT sum(lifetime_net_revenue) AS total FROM m_customers WHERE has_purchased) ORDER BY revenue_decile",
    ),
    # checks
    "chk_unique": _out(
        "l_orderkey n_rows", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1"
    ),
    "chk_unique_combination": _out(
        "l_orderkey l_linenumber n_rows",
        "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    ),
    "chk_not_null": _out("user_id", "SELECT user_id FROM c_users WHERE postal_code IS NULL"),
    "chk_accepted_values": _out(
        "order_id order_status", "SELECT * FROM c_orders WHERE order_status IN ('Cancelled', 'Returned')"
    ),
    "chk_relationships": _out(
        "key n_rows",
        "SELECT inventory_item_id AS key, count(*) AS n_rows FROM c_items ANTI JOIN c_inventory USING (inventory_item_id) "
        "GROUP BY 1",
    ),
    "chk_accepted_range": _out(
        "product_id list_price", "SELECT * FROM c_products WHERE list_price <= 25 OR list_price >= 200"
    ),
    "chk_where_severity": _out(
        "order_item_id net_margin_pct", "SELECT * FROM units WHERE net_margin_pct < 0.45 OR net_margin_pct > 0.55"
    ),
    "chk_cancelled_zero_revenue": _out(
        "order_id order_status net_revenue",
        "SELECT * FROM m_orders WHERE order_status IN ('Cancelled', 'Returned') AND net_revenue > 0",
    ),
    "chk_cohort_full_retention": _out(
        "cohort_month retention_rate",
        "SELECT * FROM m_cohorts WHERE months_since_first_purchase = 0 AND retention_rate < 0.9999",
    ),
    "chk_plausible_volume": _out(
        "revenue_date orders_placed trailing_avg_orders ratio",
        "SELECT revenue_date, orders_placed, round(trailing_avg_orders, 1) AS trailing_avg_orders, "
        "round(orders_placed / trailing_avg_orders, 2) AS ratio FROM usual_volume WHERE is_revenue_complete "
        "AND trailing_avg_orders > 2 AND NOT orders_placed BETWEEN trailing_avg_orders * 0.35::DOUBLE "
        "AND trailing_avg_orders * 2",
    ),
    "chk_completeness_invariant": _out(
        "order_id ordered_date order_status items_ordered",
        "SELECT * FROM m_orders WHERE is_revenue_complete AND line_items IS NULL",
    ),
    "chk_completeness_window": _out("max_order_date complete_through window_days", _RAW_WINDOW.strip()),
    "chk_first_order_after_registration": _out(
        "user_id registered_date first_order_date", "SELECT * FROM m_customers WHERE registered_date > first_order_date"
    ),
    "chk_incomplete_null_revenue": _out(
        "order_id ordered_date net_revenue", "SELECT * FROM m_orders WHERE line_items IS NULL AND net_revenue IS NOT NULL"
    ),
    "chk_ltv_unknown_not_zero": _out(
        "user_id lifetime_orders lifetime_orders_missing_economics lifetime_net_revenue avg_order_value",
        "SELECT * FROM m_customers WHERE has_purchased AND lifetime_orders = lifetime_orders_missing_economics "
        "AND avg_order_value IS NOT NULL",
    ),
    "chk_no_future_orders": _out(
        "order_id ordered_at", "SELECT * FROM c_orders WHERE ordered_at > TIMESTAMP '2001-07-01'"
    ),
    "chk_revenue_reconciles": _out(
        "order_id order_revenue line_item_revenue difference",
        "SELECT o.order_id, o.net_revenue AS order_revenue, i.total AS line_item_revenue, "
        "abs(o.net_revenue - i.total) AS difference FROM m_orders o JOIN "
        "(SELECT order_id, sum(net_revenue) AS total FROM units GROUP BY 1) i USING (order_id) "
        "WHERE abs(o.net_revenue - i.total) > 0.01",
    ),
}

# the same checks on data made to break them
ORACLES["chk_cancelled_zero_revenue_fires"] = _out(
    "order_id order_status net_revenue",
    "SELECT * FROM m_orders WHERE order_status IN ('Cancelled', 'Returned') AND net_revenue > 0",
    src_items="SELECT * REPLACE (if(id % 5 = 0, 'Complete', status) AS status) FROM (" + RELATIONS["src_items"] + ")",
)
ORACLES["chk_first_order_after_registration_fires"] = _out(
    "user_id registered_date first_order_date",
    "SELECT user_id, registered_date + 800 AS registered_date, first_order_date FROM m_customers "
    "WHERE registered_date + 800 > first_order_date AND registered_at <= TIMESTAMP '2001-08-01' - to_days(800)",
)
ORACLES["chk_incomplete_null_revenue_fires"] = _out(
    "order_id ordered_date net_revenue",
    "SELECT order_id, ordered_date, 0 AS net_revenue FROM c_orders ANTI JOIN c_items USING (order_id)",
)
ORACLES["chk_completeness_invariant_fires"] = _out(
    "order_id ordered_date order_status items_ordered", "SELECT * FROM c_orders ANTI JOIN c_items USING (order_id)"
)
ORACLES["chk_revenue_reconciles_fires"] = _out(
    "order_id order_revenue line_item_revenue difference",
    "SELECT order_id, sum(net_revenue) AS order_revenue, sum(net_revenue) + 0.02 * extra AS line_item_revenue, "
    "0.02 * extra AS difference FROM units JOIN (SELECT order_id, count(*) AS extra FROM units "
    "WHERE order_item_id % 5 = 0 AND is_revenue_recognised GROUP BY 1) USING (order_id) GROUP BY order_id, extra",
)
ORACLES["chk_cohort_full_retention_fires"] = _out(
    "cohort_month retention_rate",
    f"SELECT * FROM (SELECT cohort_month, {ratio('active_customers', 'cohort_customers + 1', 4)} AS retention_rate "
    "FROM m_cohorts WHERE months_since_first_purchase = 0) WHERE retention_rate < 0.9999",
)
ORACLES["chk_ltv_unknown_not_zero_fires"] = _out(
    "user_id lifetime_orders lifetime_orders_missing_economics lifetime_net_revenue avg_order_value",
    "SELECT user_id, lifetime_orders, lifetime_orders_missing_economics, lifetime_net_revenue, 0 AS avg_order_value "
    "FROM m_customers WHERE has_purchased AND lifetime_orders = lifetime_orders_missing_economics",
    src_items="SELECT * FROM (" + RELATIONS["src_items"] + ") WHERE user_id % 20 <> 0",
)

# metrics by month: (relation, time column, SQL of the value)
def _div(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0)"


_PLACED = "count(*)"
_RECOGNISED = "count(*) FILTER (is_revenue_recognised)"
_PURCHASED = "count(*) FILTER (has_purchased)"
_BY_ORDER = {
    "net_revenue": "sum(net_revenue)",
    "gross_profit": "sum(net_gross_profit)",
    "gross_margin_pct": _div("sum(net_gross_profit)", "sum(net_revenue)"),
    "order_count": _RECOGNISED,
    "orders_placed": _PLACED,
    "units_sold": "sum(units_sold)",
    "average_order_value": _div("sum(net_revenue)", _RECOGNISED),
    "cancelled_orders": "count(*) FILTER (is_cancelled)",
    "returned_orders": "count(*) FILTER (is_returned)",
    "cancellation_rate": _div("count(*) FILTER (is_cancelled)", _PLACED),
    "return_rate": _div("count(*) FILTER (is_returned)", _PLACED),
    "repeat_orders": "count(*) FILTER (is_repeat_purchase)",
    "purchasing_customers": "count(DISTINCT user_id)",
    "repeat_purchase_rate": _div("count(*) FILTER (is_repeat_purchase)", _RECOGNISED),
}
_BY_CUSTOMER = {
    "registered_customers": "count(*)",
    "purchasing_customers_lifetime": _PURCHASED,
    "repeat_customers": "count(*) FILTER (is_repeat_customer)",
    "repeat_customer_rate": _div("count(*) FILTER (is_repeat_customer)", _PURCHASED),
    "conversion_rate": _div(_PURCHASED, "count(*)"),
    "active_customers": "count(*) FILTER (is_active)",
    "lifetime_revenue": "sum(lifetime_net_revenue)",
    "lifetime_value_per_customer": _div("sum(lifetime_net_revenue)", _PURCHASED),
}
_MEASURES = {
    "cogs_measure": ("msr_cogs", "m_orders", "sum(net_cogs)"),
    "item_revenue_measure": ("msr_item_revenue", "units", "sum(net_revenue)"),
    "item_units_measure": ("msr_item_units", "units", "sum(net_units)"),
    "returned_units_measure": ("msr_returned_units", "units", "count(*) FILTER (is_returned)"),
    "line_item_measure": ("msr_line_items", "units", "count(*)"),
}


def _monthly(name: str, relation: str, day: str, value: str) -> str:
    return _out(
        ["metric_time__month", name],
        f"SELECT date_trunc('month', {day}) AS metric_time__month, {value} AS {name} FROM {relation} GROUP BY 1",
    )


for _name, _value in _BY_ORDER.items():
    ORACLES[f"met_{_name}"] = _monthly(_name, "m_orders", "ordered_date", _value)
for _name, _value in _BY_CUSTOMER.items():
    ORACLES[f"met_{_name}"] = _monthly(_name, "m_customers", "registered_date", _value)
for _name, (_key, _relation, _value) in _MEASURES.items():
    ORACLES[_key] = _monthly(_name, _relation, "ordered_date", _value)

_GROWTH = (
    "(CAST(c.v AS DOUBLE) - CAST(p.v AS DOUBLE)) / nullif(CAST(p.v AS DOUBLE), 0)"
)
ORACLES["met_net_revenue_mom_growth"] = _out(
    "metric_time__month net_revenue_mom_growth",
    f"SELECT c.m AS metric_time__month, {_GROWTH} AS net_revenue_mom_growth FROM "
    "(SELECT ordered_month AS m, sum(net_revenue) AS v FROM m_orders GROUP BY 1) c LEFT JOIN "
    "(SELECT ordered_month AS m, sum(net_revenue) AS v FROM m_orders GROUP BY 1) p ON p.m = c.m - INTERVAL 1 MONTH",
)
ORACLES["mq_offset"] = _out(
    "metric_time__month customer__country net_revenue net_revenue_mom_growth",
    f"SELECT c.m AS metric_time__month, c.country AS customer__country, c.v AS net_revenue, {_GROWTH} "
    "AS net_revenue_mom_growth FROM (SELECT ordered_month AS m, country, sum(net_revenue) AS v FROM m_orders "
    "LEFT JOIN c_users USING (user_id) GROUP BY 1, 2) c LEFT JOIN (SELECT ordered_month AS m, country, "
    "sum(net_revenue) AS v FROM m_orders LEFT JOIN c_users USING (user_id) GROUP BY 1, 2) p "
    "ON p.m = c.m - INTERVAL 1 MONTH AND p.country IS NOT DISTINCT FROM c.country",
)
ORACLES["mq_offset_day"] = _out(
    "metric_time__day net_revenue net_revenue_mom_growth",
    f"SELECT c.d AS metric_time__day, c.v AS net_revenue, {_GROWTH} AS net_revenue_mom_growth FROM "
    "(SELECT ordered_date AS d, sum(net_revenue) AS v FROM m_orders GROUP BY 1) c LEFT JOIN "
    "(SELECT ordered_date AS d, sum(net_revenue) AS v FROM m_orders GROUP BY 1) p "
    "ON p.d = CAST(c.d - INTERVAL 1 MONTH AS DATE)",
)
ORACLES["mq_time_grain"] = _out(
    "metric_time net_revenue order_count grain",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT date_trunc('{g}', ordered_date) AS metric_time, sum(net_revenue) AS net_revenue, "
        f"{_RECOGNISED} AS order_count, '{g}' AS grain FROM m_orders GROUP BY 1"
        for g in ("day", "week", "month", "quarter", "year")
    )
    + ")",
)
ORACLES["mq_categorical"] = _out(
    "order_status is_revenue_complete net_revenue orders_placed",
    "SELECT order_status, is_revenue_complete, sum(net_revenue) AS net_revenue, count(*) AS orders_placed "
    "FROM m_orders GROUP BY 1, 2",
)
ORACLES["mq_entity_join"] = _out(
    "customer__traffic_source repeat_purchase_rate order_count",
    f"SELECT traffic_source AS customer__traffic_source, {_BY_ORDER['repeat_purchase_rate']} AS repeat_purchase_rate, "
    f"{_RECOGNISED} AS order_count FROM m_orders LEFT JOIN c_users USING (user_id) GROUP BY 1",
)
ORACLES["mq_two_hop"] = _out(
    "order__customer__country department item_revenue_measure line_item_measure",
    "SELECT country AS order__customer__country, department, sum(u.net_revenue) AS item_revenue_measure, "
    "count(*) AS line_item_measure FROM units u LEFT JOIN c_orders o USING (order_id) "
    "LEFT JOIN c_users c ON c.user_id = o.user_id WHERE o.order_status <> 'Cancelled' GROUP BY 1, 2",
)
ORACLES["mq_multi_metric"] = _out(
    "metric_time__quarter net_revenue average_order_value registered_customers item_units_measure",
    "SELECT * FROM (SELECT date_trunc('quarter', ordered_date) AS metric_time__quarter, sum(net_revenue) AS net_revenue, "
    f"{_BY_ORDER['average_order_value']} AS average_order_value FROM m_orders GROUP BY 1) "
    "FULL JOIN (SELECT date_trunc('quarter', registered_date) AS metric_time__quarter, count(*) AS registered_customers "
    "FROM c_users GROUP BY 1) USING (metric_time__quarter) FULL JOIN (SELECT date_trunc('quarter', ordered_date) AS "
    "metric_time__quarter, sum(net_units) AS item_units_measure FROM units GROUP BY 1) USING (metric_time__quarter)",
)
ORACLES["mq_ratio"] = _out(
    "metric_time__week gross_margin_pct cancellation_rate return_rate",
    f"SELECT date_trunc('week', ordered_date) AS metric_time__week, {_BY_ORDER['gross_margin_pct']} AS gross_margin_pct, "
    f"{_BY_ORDER['cancellation_rate']} AS cancellation_rate, {_BY_ORDER['return_rate']} AS return_rate "
    "FROM m_orders GROUP BY 1",
)
ORACLES["mq_zero_fill"] = _out(
    "metric_time net_revenue orders_placed", "SELECT revenue_date AS metric_time, net_revenue, orders_placed FROM m_daily"
)

RELATIONS["spine_days"] = (
    "SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS date_day"
)
RELATIONS["young_months"] = (
    "SELECT date_trunc('month', ordered_date) AS month, traffic_source, sum(net_revenue) AS revenue, "
    f"count(*) AS placed, {_BY_ORDER['average_order_value']} AS average_order_value FROM m_orders "
    "JOIN m_customers USING (user_id) WHERE age BETWEEN 18 AND 24 GROUP BY 1, 2"
)
ORACLES["mq_zero_fill_by_source"] = _out(
    "metric_time__month customer__traffic_source net_revenue orders_placed average_order_value",
    "SELECT month AS metric_time__month, traffic_source AS customer__traffic_source, coalesce(revenue, 0) AS net_revenue, "
    "coalesce(placed, 0) AS orders_placed, average_order_value FROM (SELECT DISTINCT date_trunc('month', date_day) AS month "
    "FROM spine_days) CROSS JOIN (SELECT DISTINCT traffic_source FROM young_months) "
    "LEFT JOIN young_months USING (month, traffic_source)",
)
ORACLES["mq_time_grain_customers"] = _out(
    "grain metric_time customer__gender purchasing_customers average_order_value",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{g}' AS grain, date_trunc('{g}', ordered_date) AS metric_time, gender AS customer__gender, "
        f"count(DISTINCT user_id) AS purchasing_customers, {_BY_ORDER['average_order_value']} AS average_order_value "
        "FROM m_orders LEFT JOIN c_users USING (user_id) GROUP BY ALL"
        for g in ("day", "week", "month", "quarter", "year")
    )
    + ")",
)
ORACLES["mq_customer_segments"] = _out(
    "customer__customer_status customer__is_active customer__age_band registered_customers orders_placed "
    "lifetime_value_per_customer",
    "SELECT customer_status AS customer__customer_status, is_active AS customer__is_active, age_band AS customer__age_band, "
    "sum(customers) AS registered_customers, sum(placed) AS orders_placed, "
    f"{_div('sum(revenue)', 'sum(buyers)')} AS lifetime_value_per_customer FROM ("
    "SELECT customer_status, is_active, age_band, 1 AS customers, NULL AS placed, lifetime_net_revenue AS revenue, "
    "has_purchased::INT AS buyers FROM m_customers UNION ALL "
    "SELECT customer_status, is_active, age_band, NULL, 1, NULL, NULL FROM m_orders LEFT JOIN m_customers USING (user_id)) "
    "GROUP BY ALL",
)
ORACLES["mq_brand_status"] = _out(
    "brand item_status item_revenue_measure returned_units_measure",
    "SELECT brand, item_status, sum(net_revenue) AS item_revenue_measure, count(*) FILTER (is_returned) AS "
    "returned_units_measure FROM units GROUP BY 1, 2",
)
ORACLES["mq_cohort_quarter"] = _out(
    "cohort_month__quarter is_first_purchase net_revenue purchasing_customers",
    "SELECT CAST(date_trunc('quarter', cohort_month) AS DATE) AS cohort_month__quarter, is_first_purchase, sum(net_revenue) AS net_revenue, "
    "count(DISTINCT user_id) AS purchasing_customers FROM m_orders GROUP BY 1, 2",
)

# the check report, every rule written out: keys, then values, then references
_UNIQUE = {
    "source.users": ("src_users", "id"), "source.orders": ("src_orders", "order_id"), "source.order_items": ("src_items", "id"),
    "source.products": ("src_products", "id"), "source.inventory_items": ("src_inventory", "id"),
    "source.distribution_centers": ("src_centers", "id"), "source.events": ("src_events", "id"), "users": ("c_users", "user_id"),
    "orders": ("c_orders", "order_id"), "order_items": ("c_items", "order_item_id"), "products": ("c_products", "product_id"),
    "inventory_items": ("c_inventory", "inventory_item_id"), "events": ("c_events", "event_id"),
    "distribution_centers": ("c_centers", "distribution_center_id distribution_center_name"),
    "fct_orders": ("m_orders", "order_id"), "fct_order_items": ("units", "order_item_id"),
    "dim_customers": ("m_customers", "user_id"), "dim_products": ("m_products", "product_id"),
    "fct_daily_revenue": ("m_daily", "revenue_date"), "time_spine": ("spine_days", "date_day"),
}
_GRAINS = [
    ("mart_product_performance", "m_performance", "revenue_month, product_id"),
    ("mart_customer_cohorts", "m_cohorts", "cohort_month, months_since_first_purchase"),
    ("mart_acquisition_channels", "m_channels", "registration_month, traffic_source"),
]
#: beside the unique keys, none of which may be null
_PRESENT = [
    ("source.orders", "src_orders", "user_id"),
    ("source.order_items", "src_items", "order_id"),
    ("users", "c_users", "email registered_at"),
    ("orders", "c_orders", "user_id order_status"),
    ("order_items", "c_items", "order_id product_id sale_price"),
    ("products", "c_products", "sku category"),
    ("inventory_items", "c_inventory", "product_id unit_cost"),
    ("events", "c_events", "event_type session_id"),
    ("fct_orders", "m_orders", "user_id is_revenue_recognised has_line_items is_revenue_complete ordered_date"),
    ("fct_orders", "(SELECT * FROM m_orders WHERE is_revenue_complete)", "net_revenue"),
    ("fct_order_items", "units", "order_id"),
    ("dim_customers", "m_customers", "customer_status lifetime_net_revenue lifetime_orders lifetime_incomplete_orders "
     "has_incomplete_orders lifetime_orders_missing_economics"),
    ("dim_products", "m_products", "sku"),
    ("fct_daily_revenue", "m_daily", "is_revenue_complete net_revenue"),
    ("mart_product_performance", "m_performance", "product_id revenue_month"),
    ("mart_customer_cohorts", "m_cohorts", "cohort_month cohort_customers"),
    ("mart_acquisition_channels", "m_channels", "customers_acquired"),
]
_ORDER_STATUSES = "'Processing', 'Shipped', 'Complete', 'Cancelled', 'Returned'"
_ALLOWED = [
    ("source.orders", "src_orders", "status", _ORDER_STATUSES),
    ("users", "c_users", "age_band", "'18-24', '25-34', '35-44', '45-54', '55-64', '65+'"),
    ("users", "c_users", "gender", "'M', 'F'"),
    ("orders", "c_orders", "order_status", _ORDER_STATUSES),
    ("order_items", "c_items", "item_status", _ORDER_STATUSES),
    ("products", "c_products", "department", "'Men', 'Women'"),
    ("fct_orders", "m_orders", "order_status", _ORDER_STATUSES),
    ("dim_customers", "m_customers", "customer_status", "'Never purchased', 'Active - new', 'Active - repeat', 'Lapsing', 'Churned'"),
    ("dim_products", "m_products", "price_tier", "'Budget (<$25)', 'Mid ($25-$75)', 'Premium ($75-$200)', 'Luxury ($200+)'"),
]
#: a row breaks its range where the condition holds
_RANGES = [
    ("orders", "c_orders", "items_ordered", "items_ordered < 1", "error"),
    ("orders", "c_orders", "days_to_ship", "days_to_ship < 0", "error"),
    ("order_items", "c_items", "sale_price", "sale_price < 0", "error"),
    ("products", "c_products", "list_price", "list_price <= 0", "error"),
    ("products", "c_products", "list_margin_pct", "abs(list_margin_pct) > 1", "error"),
    ("inventory_items", "c_inventory", "unit_cost", "unit_cost < 0", "error"),
    ("fct_orders", "m_orders", "net_revenue", "net_revenue < 0", "error"),
    ("fct_order_items", "units", "net_revenue", "net_revenue < 0", "error"),
    ("fct_order_items", "units", "net_margin_pct", "net_margin_pct < -5 OR net_margin_pct > 1", "warn"),
    ("dim_customers", "m_customers", "lifetime_net_revenue", "lifetime_net_revenue < 0", "error"),
    ("dim_customers", "m_customers", "lifetime_orders", "lifetime_orders < 0", "error"),
    ("dim_customers", "m_customers", "avg_order_value", "avg_order_value <= 0", "error"),
    ("dim_products", "m_products", "sell_through_rate", "sell_through_rate < 0 OR sell_through_rate > 1", "error"),
    ("fct_daily_revenue", "m_daily", "gross_margin_pct", "abs(gross_margin_pct) > 1", "error"),
    ("fct_daily_revenue", "m_daily", "cancellation_rate", "cancellation_rate < 0 OR cancellation_rate > 1", "error"),
    ("mart_customer_cohorts", "m_cohorts", "retention_rate", "retention_rate < 0 OR retention_rate > 1", "error"),
    ("mart_customer_cohorts", "m_cohorts", "cohort_customers", "cohort_customers < 1", "error"),
    ("mart_acquisition_channels", "m_channels", "conversion_rate", "conversion_rate < 0 OR conversion_rate > 1", "error"),
]
_PARENTS = [
    ("source.orders", "src_orders", "user_id", "src_users", "id"),
    ("source.order_items", "src_items", "order_id", "src_orders", "order_id"),
    ("source.order_items", "src_items", "product_id", "src_products", "id"),
    ("orders", "c_orders", "user_id", "c_users", "user_id"),
    ("order_items", "c_items", "order_id", "c_orders", "order_id"),
    ("order_items", "c_items", "product_id", "c_products", "product_id"),
    ("order_items", "c_items", "inventory_item_id", "c_inventory", "inventory_item_id"),
    ("inventory_items", "c_inventory", "product_id", "c_products", "product_id"),
    ("fct_orders", "m_orders", "user_id", "m_customers", "user_id"),
    ("fct_order_items", "units", "order_id", "m_orders", "order_id"),
    ("fct_order_items", "units", "product_id", "m_products", "product_id"),
]


def _failures() -> list[tuple[str, str, str, str, str]]:
    """check, table, column, severity and SQL of the violating rows or keys of each rule."""
    found = []
    for table, (relation, columns) in _UNIQUE.items():
        for c in columns.split():
            repeated = f"SELECT {c} FROM {relation} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
            found.append(("unique", table, c, "error", repeated))
            found.append(("not_null", table, c, "error", f"SELECT 1 FROM {relation} WHERE {c} IS NULL"))
    for table, relation, columns in _GRAINS:
        found.append(("unique_combination", table, columns, "error", f"SELECT {columns} FROM {relation} GROUP BY ALL HAVING count(*) > 1"))
    for table, relation, columns in _PRESENT:
        found += [("not_null", table, c, "error", f"SELECT 1 FROM {relation} WHERE {c} IS NULL") for c in columns.split()]
    for table, relation, c, values in _ALLOWED:
        found.append(("accepted_values", table, c, "error", f"SELECT 1 FROM {relation} WHERE {c} NOT IN ({values})"))
    for table, relation, c, broken, severity in _RANGES:
        found.append(("accepted_range", table, c, severity, f"SELECT 1 FROM {relation} WHERE {broken}"))
    for table, relation, c, parent, key in _PARENTS:
        found.append(("relationships", table, c, "error", f"SELECT 1 FROM {relation} WHERE {c} NOT IN (SELECT {key} FROM {parent})"))
    return found


_ASSERTED = [
    ("cancelled_orders_have_zero_revenue", "fct_orders",
     "SELECT 1 FROM m_orders WHERE order_status IN ('Cancelled', 'Returned') AND net_revenue > 0"),
    ("complete_orders_have_items", "fct_orders", "SELECT 1 FROM m_orders WHERE is_revenue_complete AND line_items IS NULL"),
    ("incomplete_orders_have_null_revenue", "fct_orders",
     "SELECT 1 FROM m_orders WHERE line_items IS NULL AND net_revenue IS NOT NULL"),
    ("no_future_orders", "fct_orders", "SELECT 1 FROM m_orders WHERE ordered_at > TIMESTAMP '2001-08-01'"),
    ("cohort_starts_at_full_retention", "mart_customer_cohorts",
     "SELECT 1 FROM m_cohorts WHERE months_since_first_purchase = 0 AND active_customers < cohort_customers"),
    ("first_order_not_before_registration", "dim_customers",
     "SELECT 1 FROM m_customers WHERE registered_date > first_order_date"),
    ("unknown_value_is_not_zero", "dim_customers",
     "SELECT 1 FROM m_customers WHERE has_purchased AND lifetime_orders = lifetime_orders_missing_economics "
     "AND avg_order_value IS NOT NULL"),
    ("complete_days_have_plausible_volume", "fct_daily_revenue",
     "SELECT 1 FROM usual_volume WHERE is_revenue_complete AND trailing_avg_orders > 2 AND "
     "(orders_placed > trailing_avg_orders * 2 OR orders_placed < trailing_avg_orders * 0.35::DOUBLE)"),
    ("completeness_window_is_sane", "fct_orders",
     "SELECT 1 FROM (SELECT max(ordered_date) AS d, max(ordered_date) FILTER (is_revenue_complete) AS c FROM m_orders) "
     "WHERE c IS NULL OR d - c > 14"),
    ("order_revenue_ties_to_items", "fct_orders",
     "SELECT 1 FROM m_orders o JOIN (SELECT order_id, sum(net_revenue) AS total FROM units GROUP BY 1) i "
     "USING (order_id) WHERE abs(o.net_revenue - i.total) > 0.01"),
]
_COUNTED = [
    f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
    f"'{severity}' AS severity, (SELECT count(*) FROM ({rows})) AS failures"
    for check, table, column, severity, rows in _failures()
] + [
    f"SELECT '{name}', '{mart}', '', 'error', (SELECT count(*) FROM ({rows}))" for name, mart, rows in _ASSERTED
]
ORACLES["chk_run_report"] = _out(
    "check_name table_name column_name severity failures status",
    "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
    f"FROM ({' UNION ALL '.join(_COUNTED)})",
)
