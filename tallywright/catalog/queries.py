"""Every operator as a named query over the whole test tables.

A query is a function of a ``Sample`` (the models over one data folder) and
returns a DataFrame. Results leave through ``portable``, which turns decimals into
doubles so that another engine's results compare equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.config import Config
from tallywright.functions import dates, money, rules, text
from tallywright.functions import fixed_values as fixed
from tallywright.operators import calendar, checks, completeness, economics, history, joins, ranking, staging
from tallywright.plans import contracts, core, finance, invariants, marketing, metrics
from tallywright.plans.warehouse import Warehouse, build
from tallywright.session import configure, shared_folder
from tallywright.sources import sinks, tables
from tallywright.sources.sample import raw_orders_and_items, raw_tables, sample_sources

SAMPLE_CONFIG = Config(
    analysis_start=date(1994, 1, 1), clamp_ts=datetime(2001, 8, 1), volume_warm_up=2.0
)
EVENTS_CONFIG = replace(SAMPLE_CONFIG, clamp_ts=datetime(2024, 12, 31))
FRESHNESS_NOW = datetime(2001, 8, 2, 12)


class Sample(Warehouse):
    """The models over the mapped test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(sample_sources(spark, folder), SAMPLE_CONFIG)
        self.spark = spark
        self.folder = folder

    @property
    def events(self) -> DataFrame:
        return staging.stage_events(self.sources["events"], EVENTS_CONFIG)

    def scratch(self, name: str) -> str:
        return f"{shared_folder(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def stored(self) -> Callable[[str], DataFrame]:
        """The marts built and written once, for queries that read many of them."""
        built = build(self.sources, self.cfg, self.scratch("marts"))
        return lambda name: self.events if name == "events" else built.frame(name)


def portable(df: DataFrame) -> DataFrame:
    def cast(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.IntegralType):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)

    return df.select(*(cast(f) for f in df.schema))


QUERIES: dict[str, Callable[[Sample], DataFrame]] = {}


def query(name: str):
    def register(fn: Callable[[Sample], DataFrame]):
        QUERIES[name] = fn
        return fn

    return register


def _add(**named: Callable[[Sample], DataFrame]) -> None:
    QUERIES.update(named)


# sources and sinks ---------------------------------------------------------------
@query("src_scan")
def _(w):
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in w.sources.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("src_freshness")
def _(w):
    now = F.lit(FRESHNESS_NOW.isoformat(sep=" ")).cast("timestamp_ntz")
    return tables.freshness(w.sources, now, w.cfg)


@query("sink_table")
def _(w):
    """Built twice: the second version replaces the first."""
    table = sinks.VersionedTable(w.spark, w.scratch("table"))
    table.replace(lambda path: sinks.write_table(w.mart_acquisition_channels.limit(0), path))
    return table.replace(lambda path: sinks.write_table(w.mart_acquisition_channels, path))


@query("sink_month_partitioned")
def _(w):
    kept = sinks.VersionedTable(w.spark, w.scratch("months")).replace(
        lambda path: sinks.write_month_partitioned(
            w.fct_orders, path, "ordered_date", ["order_status", "user_id"], ["order_id"]
        )
    )
    return kept.select("order_id", "order_status", "user_id", "ordered_date", "partition_month", "net_revenue")


@query("sink_clustered")
def _(w):
    return sinks.VersionedTable(w.spark, w.scratch("clustered")).replace(
        lambda path: sinks.write_clustered(w.dim_products, path, ["department", "category"], ["product_id"])
    )


# staging, filters, projections -----------------------------------------------------
_add(
    stg_users=lambda w: w.users,
    stg_orders=lambda w: w.orders,
    stg_order_items=lambda w: w.order_items,
    stg_products=lambda w: w.products,
    stg_inventory_items=lambda w: w.inventory_items,
    stg_distribution_centers=lambda w: w.distribution_centers,
    stg_events=lambda w: w.events,
    flt_time_clamp=lambda w: staging.within_window(
        w.sources["orders"], replace(w.cfg, clamp_ts=datetime(2000, 12, 31))
    ).select("order_id", "created_at"),
    prj_age_band=lambda w: w.sources["users"].select("id", "age", rules.age_band(F.col("age")).alias("age_band")),
    prj_price_tier=lambda w: w.products.select(
        "product_id", "list_price", rules.price_tier(F.col("list_price")).alias("price_tier")
    ),
    prj_customer_status=lambda w: w.dim_customers.select(
        "user_id", "lifetime_orders", "days_since_last_order", "customer_status"
    ),
    prj_net_gross_split=lambda w: w.enriched_items.select(
        "order_item_id", "gross_revenue", "net_revenue", "net_cogs", "returned_revenue", "net_units", "discount_amount"
    ),
    prj_margin=lambda w: w.enriched_items.select("order_item_id", "net_gross_profit", "net_margin_pct"),
    prj_purchase_flags=lambda w: history.sequence_orders(w.orders).select(
        "order_id", "purchase_seq", "is_first_purchase", "is_repeat_purchase"
    ),
    flt_has_purchased=lambda w: w.dim_customers.where("has_purchased").select("user_id", "lifetime_net_revenue"),
    flt_recognised_with_cohort=lambda w: history.cohort_purchases(history.sequence_orders(w.orders)).select(
        "order_id", "user_id", "cohort_month", "months_since_first_purchase"
    ),
)


@query("prj_status_flags")
def _(w):
    flags = rules.status_flags(F.col("status"), w.cfg.revenue_statuses)
    return w.sources["order_items"].select("id", "status", *(c.alias(n) for n, c in flags.items()))


# joins -------------------------------------------------------------------------------
_add(
    join_items_inventory=lambda w: economics.join_inventory(
        w.order_items, w.inventory_items, joins.hot_keys(w.order_items, "inventory_item_id")["inventory_item_id"]
    ).select("order_item_id", "inventory_item_id", "unit_cost"),
    join_items_products=lambda w: economics.join_products(
        w.order_items, w.products, joins.hot_keys(w.order_items, "product_id")["product_id"]
    ).select(
        "order_item_id", "product_id", "product_name", "brand", "category", "department", "list_price", "list_cost"
    ),
    join_orders_economics=lambda w: history.join_economics(w.orders, w.order_sums).select(
        "order_id", "user_id", "line_items", "units_sold", "net_revenue", "net_gross_profit"
    ),
    join_orders_history=lambda w: w.order_facts.select(
        "order_id", "order_seq", "purchase_seq", "is_first_purchase", "is_repeat_purchase", "cohort_month",
        "months_since_first_purchase", "line_items", "net_revenue",
    ),
    anti_first_gap=lambda w: completeness.first_gap(w.orders, w.order_items),
    cross_completeness=lambda w: completeness.with_one_row(
        w.orders.select("order_id", "ordered_date"), w.boundary
    ).withColumn("is_revenue_complete", F.col("ordered_date") <= F.col("complete_through")),
    cross_asof=lambda w: completeness.with_one_row(w.users.select("user_id", "registered_date"), w.as_of),
    join_customers_orders=lambda w: w.users.select("user_id").join(core.customer_orders(w.order_facts), "user_id", "left"),
    join_products_centers=lambda w: w.products.join(
        w.distribution_centers, "distribution_center_id", "left"
    ).select("product_id", "distribution_center_id", "distribution_center_name"),
    join_products_inventory_agg=lambda w: w.products.select("product_id", "list_cost").join(
        core.inventory_by_product(w.inventory_items), "product_id", "left"
    ),
    join_perf_products=lambda w: finance.with_ratios(
        finance.with_product(finance.product_month(w.fct_order_items), w.dim_products)
    ),
    join_cohort_size_period=lambda w: _cohort_size_period(w),
    join_reconcile=lambda w: invariants.reconcile_revenue(w.order_facts, w.fct_order_items),
    scalar_subquery=lambda w: completeness.with_one_row(
        completeness.first_gap(w.orders, w.order_items), completeness.latest_order_date(w.orders, "max_order_date")
    ).withColumn("last_seen", F.coalesce("first_incomplete_date", "max_order_date")),
)


@query("join_spine_daily")
def _(w):
    spine = calendar.spine_between(calendar.order_date_bounds(w.orders), "start_date", "end_date", "revenue_date")
    placed = w.orders.groupBy(F.col("ordered_date").alias("revenue_date")).agg(F.count("*").alias("orders_placed"))
    return spine.join(placed, "revenue_date", "left").select(
        "revenue_date", F.coalesce("orders_placed", F.lit(0)).alias("orders_placed")
    )


def _cohort_size_period(w):
    activity = marketing.cohort_activity(history.order_history(w.orders, w.order_sums))
    return marketing.cohort_sizes(activity).join(marketing.cohort_max_offset(activity), "cohort_month")


@query("join_grid_activity")
def _(w):
    activity = w.cohort_activity
    keys = ["cohort_month", "months_since_first_purchase"]
    return marketing.cohort_grid(activity).join(activity.select(*keys, "active_customers", "orders"), keys, "left")


@query("lateral_unnest")
def _(w):
    """Each order's days between order and delivery, one row per day."""
    days = calendar.each_day(F.col("ordered_date"), F.to_date("delivered_at"))
    return w.orders.select("order_id", F.explode(days).alias("day"))


@query("semi_fk")
def _(w):
    """Foreign keys without a parent row, over all declared references and one that has gaps here."""
    declared = [c for c in contracts.CONTRACTS if c.check == "relationships"]
    # headers whose lines have not landed
    late = contracts.Contract("relationships", "orders", ("order_id",), parent="order_items", parent_key="order_id")
    return contracts.lost_references(w.facts, [*declared, late])


# aggregations ----------------------------------------------------------------------------
_add(
    orders_aggregated=lambda w: w.order_rollup,
    customer_orders=lambda w: core.customer_orders(w.order_facts),
    inventory_by_product=lambda w: core.inventory_by_product(w.inventory_items),
    daily_orders=lambda w: finance.daily_orders(w.order_facts),
    product_month=lambda w: finance.product_month(w.fct_order_items),
    channel_month=lambda w: marketing.channel_month(w.dim_customers),
    cohort_sizes=lambda w: marketing.cohort_sizes(w.cohort_activity),
    cohort_max_offset=lambda w: marketing.cohort_max_offset(w.cohort_activity),
    cohort_activity=lambda w: w.cohort_activity,
    global_minmax=lambda w: calendar.order_date_bounds(w.orders),
    complete_through_day=lambda w: w.order_facts.where("is_revenue_complete").agg(
        F.max("ordered_date").alias("complete_through")
    ),
    order_item_revenue=lambda w: economics.revenue_by_order(w.fct_order_items),
    agg_countif=lambda w: w.orders.groupBy("ordered_month").agg(
        F.count_if("is_revenue_recognised").alias("recognised"),
        F.count_if("is_cancelled").alias("cancelled"),
        F.count_if("is_returned").alias("returned"),
    ),
    agg_count_distinct=lambda w: w.orders.groupBy("ordered_month").agg(F.countDistinct("user_id").alias("customers")),
    agg_cond_sum_minmax=lambda w: w.orders.groupBy("user_id").agg(
        F.sum(F.when(F.col("is_revenue_recognised"), F.col("items_ordered"))).alias("recognised_items"),
        F.min(F.when(F.col("is_revenue_recognised"), F.col("ordered_date"))).alias("first_order_date"),
        F.max(F.when(F.col("is_revenue_recognised"), F.col("ordered_date"))).alias("latest_order_date"),
    ),
    agg_any_value=lambda w: w.order_rollup.select("order_id", "sample_category"),
)


@query("agg_of_agg_window")
def _(w):
    """Revenue per price tier and its share: a sum over the sums."""
    tiers = w.fct_order_items.groupBy(rules.price_tier(F.col("list_price")).alias("price_tier")).agg(
        F.sum("net_revenue").alias("revenue")
    )
    total = F.sum("revenue").over(Window.partitionBy())
    return tiers.select("price_tier", "revenue", money.ratio(F.col("revenue"), total, 4).alias("share"))


# windows ------------------------------------------------------------------------------------
_add(
    win_order_seq=lambda w: history.sequence_orders(w.orders).select("order_id", "user_id", "order_seq"),
    win_purchase_seq=lambda w: history.sequence_orders(w.orders).select("order_id", "user_id", "purchase_seq"),
    win_first_purchase=lambda w: history.sequence_orders(w.orders).select("order_id", "first_purchase_at"),
    win_latest_purchase=lambda w: history.sequence_orders(w.orders).select("order_id", "latest_purchase_at"),
    win_trailing_7d=lambda w: w.fct_daily_revenue.select("revenue_date", "net_revenue", "net_revenue_7d_avg"),
    win_lag_364=lambda w: w.fct_daily_revenue.select("revenue_date", "net_revenue", "net_revenue_ly"),
    win_rank_in_category=lambda w: w.product_ranks.select(
        "revenue_month", "category", "product_id", "net_revenue", "revenue_rank_in_category"
    ),
    win_cumulative_ltv=lambda w: w.mart_customer_cohorts.select(
        "cohort_month", "months_since_first_purchase", "net_revenue", "cumulative_ltv"
    ),
    win_ntile10=lambda w: marketing.customer_deciles(w.dim_customers),
)


@query("win_share_of_month")
def _(w):
    monthly = finance.product_month(w.fct_order_items).select("revenue_month", "product_id", "net_revenue")
    return finance.with_share_of_month(monthly)


@query("win_trailing_28d_excl")
def _(w):
    daily = finance.fct_daily_revenue(finance.daily_orders(w.order_facts))
    return invariants.trailing_volume(daily, w.cfg).withColumn("trailing_avg_orders", F.round("trailing_avg_orders", 4))


@query("win_total")
def _(w):
    per_month = w.orders.groupBy("ordered_month").agg(F.count("*").alias("orders_placed"))
    return per_month.withColumn("orders_total", F.sum("orders_placed").over(Window.partitionBy()))


# sorting and top-k ----------------------------------------------------------------------------
@query("sort_deciles")
def _(w):
    tiles = ranking.with_ntile(
        w.products.select("product_id", "list_price"), 10, [F.col("list_price").desc(), F.col("product_id")], "decile"
    )
    return tiles.groupBy("decile").agg(F.count("*").alias("products"), F.sum("list_price").alias("list_value")).orderBy(
        "decile"
    )


@query("topk_products")
def _(w):
    monthly = finance.with_product(finance.product_month(w.fct_order_items), w.dim_products)
    return ranking.top_within(
        monthly, ["revenue_month", "category"], finance.best_first(), 3, "revenue_rank_in_category"
    ).select("revenue_month", "category", "product_id", "net_revenue", "revenue_rank_in_category")


# scalar functions --------------------------------------------------------------------------------
_add(
    fn_blank_to_null=lambda w: w.sources["users"].select(
        "id", text.blank_to_null(F.col("postal_code")).alias("postal_code"),
        text.blank_to_null(F.col("first_name")).alias("first_name"),
    ),
    fn_title_case=lambda w: w.sources["products"].select("id", text.title_case(F.col("name")).alias("name")).unionByName(
        w.sources["users"].select("id", text.title_case(F.col("email")).alias("name"))
    ),
    fn_lower_email=lambda w: w.sources["users"].select("id", text.lower_email(F.col("email")).alias("email")),
    fn_money=lambda w: w.sources["inventory_items"].select("id", money.money(F.col("cost") * 1.0375).alias("cost")),
    fn_net_revenue=lambda w: w.sources["order_items"].select(
        "id",
        money.net_revenue(money.money(F.col("sale_price")), F.col("status"), w.cfg.revenue_statuses).alias("net_revenue"),
    ),
    fn_safe_ratio=lambda w: w.order_sums.select(
        "order_id",
        money.ratio(F.col("net_revenue"), F.col("units_sold"), 2).alias("unit_revenue"),
        money.ratio(F.col("net_gross_profit"), F.col("net_revenue"), 4).alias("margin"),
        money.ratio(F.col("returned_items"), F.col("line_items"), 6).alias("returned_share"),
    ),
    fn_round=lambda w: core.inventory_by_product(w.inventory_items).select(
        "product_id", "avg_unit_cost", "avg_days_on_shelf"
    ),
    fn_date_of_ts=lambda w: w.sources["events"].select("id", F.to_date("created_at").alias("day")),
    fn_day_diff=lambda w: w.orders.select("order_id", "days_to_ship", "days_in_transit", "days_to_deliver"),
    fn_month_diff=lambda w: history.sequence_orders(w.orders).select("order_id", "months_since_first_purchase"),
    fn_date_trunc=lambda w: w.orders.select(
        "order_id", *(dates.truncate(F.col("ordered_date"), g).alias(g) for g in ("month", "quarter", "year"))
    ),
    fn_week_monday=lambda w: w.orders.select("order_id", dates.week_of(F.col("ordered_date")).alias("week")),
    fn_week_default=lambda w: w.orders.select(
        "order_id",
        dates.week_of(F.col("ordered_date"), "monday").alias("week_monday"),
        dates.week_of(F.col("ordered_date"), "sunday").alias("week_sunday"),
    ),
    fn_day_name=lambda w: w.orders.select("order_id", dates.day_name(F.col("ordered_date")).alias("day_name")),
    fn_is_weekend=lambda w: w.orders.select("order_id", dates.is_weekend(F.col("ordered_date")).alias("is_weekend")),
    fn_date_sub=lambda w: w.orders.select(
        "order_id", F.date_sub("ordered_date", w.cfg.settling_days).alias("settled_date")
    ),
    fn_bool_to_int=lambda w: w.order_items.select(
        "order_item_id", F.col("is_revenue_recognised").cast("bigint").alias("net_units")
    ),
    fn_coalesce_zero=lambda w: w.dim_customers.select("user_id", "lifetime_orders", "lifetime_net_revenue"),
    fn_abs=lambda w: economics.join_products(w.order_items, w.products).select(
        "order_item_id", F.abs(F.col("sale_price") - F.col("list_price")).alias("off_list")
    ),
    fn_current_ts=lambda w: staging.within_window(w.sources["events"], replace(w.cfg, clamp_ts=None)).agg(
        F.count("*").alias("past_events")
    ),
)

# generators ------------------------------------------------------------------------------------------
_add(
    time_spine=lambda w: calendar.with_periods(
        calendar.spine_between(
            w.orders.agg(F.max("ordered_date").alias("last")).withColumn("first", F.lit(w.cfg.analysis_start)),
            "first",
            "last",
        ),
        w.cfg,
    ),
    gen_data_spine=lambda w: calendar.spine_between(
        calendar.order_date_bounds(w.orders), "start_date", "end_date", "revenue_date"
    ),
    gen_cohort_grid=lambda w: marketing.cohort_grid(w.cohort_activity),
)

# models -------------------------------------------------------------------------------------------------
_add(
    int_order_items_enriched=lambda w: w.enriched_items,
    int_customer_order_history=lambda w: w.order_history,
    completeness_boundary=lambda w: w.boundary,
    fct_orders=lambda w: w.fct_orders,
    fct_order_items=lambda w: w.fct_order_items,
    dim_customers=lambda w: w.dim_customers,
    dim_products=lambda w: w.dim_products,
    fct_daily_revenue=lambda w: w.fct_daily_revenue,
    mart_product_performance=lambda w: w.mart_product_performance,
    mart_customer_cohorts=lambda w: w.mart_customer_cohorts,
    mart_acquisition_channels=lambda w: w.mart_acquisition_channels,
    revenue_concentration=lambda w: w.revenue_concentration,
)


@query("mart_customer_cohorts_to_data_end")
def _(w):
    cfg = replace(w.cfg, cohort_grid_end="data")
    return marketing.mart_customer_cohorts(w.cohort_activity, cfg)


# checks ------------------------------------------------------------------------------------------------------
def _lines(w):
    """The test lines as they are: their order and line number are no key."""
    return raw_tables(w.spark, w.folder)["lineitem"]


_add(
    chk_unique=lambda w: checks.duplicates(_lines(w), "l_orderkey"),
    chk_unique_combination=lambda w: checks.duplicates(_lines(w), "l_orderkey", "l_linenumber"),
    chk_not_null=lambda w: checks.violations(w.users, checks.null_rule("postal_code")).select("user_id"),
    chk_accepted_values=lambda w: checks.violations(
        w.orders, checks.value_rule("order_status", w.cfg.revenue_statuses)
    ).select("order_id", "order_status"),
    chk_relationships=lambda w: checks.orphans(
        w.order_items, "inventory_item_id", w.inventory_items, "inventory_item_id"
    ),
    chk_accepted_range=lambda w: checks.violations(
        w.products, checks.range_rule("list_price", 25, 200, inclusive=False)
    ).select("product_id", "list_price"),
    chk_where_severity=lambda w: checks.violations(
        w.enriched_items, checks.range_rule("net_margin_pct", 0.45, 0.55), where="net_margin_pct is not null"
    ).select("order_item_id", "net_margin_pct"),
    chk_run_report=lambda w: contracts.run_report(w.stored(), w.cfg),
    chk_cancelled_zero_revenue=lambda w: invariants.invariant("cancelled_orders_have_zero_revenue", w.facts, w.cfg),
    chk_cohort_full_retention=lambda w: invariants.invariant("cohort_starts_at_full_retention", w.facts, w.cfg),
    chk_plausible_volume=lambda w: invariants.invariant("complete_days_have_plausible_volume", w.facts, w.cfg),
    chk_completeness_invariant=lambda w: invariants.invariant("complete_orders_have_items", w.facts, w.cfg),
    chk_first_order_after_registration=lambda w: invariants.invariant(
        "first_order_not_before_registration", w.frame, w.cfg
    ),
    chk_incomplete_null_revenue=lambda w: invariants.invariant("incomplete_orders_have_null_revenue", w.facts, w.cfg),
    chk_ltv_unknown_not_zero=lambda w: invariants.invariant("unknown_value_is_not_zero", w.facts, w.cfg),
    chk_no_future_orders=lambda w: invariants.invariant(
        "no_future_orders", w.facts, replace(w.cfg, clamp_ts=datetime(2001, 7, 1))
    ),
    chk_revenue_reconciles=lambda w: invariants.invariant("order_revenue_ties_to_items", w.facts, w.cfg),
)


@query("chk_completeness_window")
def _(w):
    """On the test orders as they are, old headers without lines included."""
    raw = raw_orders_and_items(w.spark, w.folder)
    orders = staging.stage_orders(raw["orders"], w.cfg)
    boundary = completeness.completeness_boundary(orders, raw["items"], w.cfg)
    flagged = completeness.with_one_row(orders, boundary).withColumn(
        "is_revenue_complete", F.col("ordered_date") <= F.col("complete_through")
    )
    return invariants.stale_completeness(flagged.drop("complete_through"), w.cfg)


def _with(w: Sample, mart: str, **columns) -> Callable[[str], DataFrame]:
    """The models with some columns of one mart replaced, as a faulty edit would."""
    return lambda name: w.facts(name).withColumns(columns) if name == mart else w.facts(name)


@query("chk_cancelled_zero_revenue_fires")
def _(w):
    """Units whose status was not updated with their order's."""
    stale = w.sources["order_items"].withColumn(
        "status", F.when(F.col("id") % 5 == 0, "Complete").otherwise(F.col("status"))
    )
    shop = Warehouse({**w.sources, "order_items": stale}, w.cfg)
    return invariants.invariant("cancelled_orders_have_zero_revenue", shop.facts, w.cfg)


@query("chk_first_order_after_registration_fires")
def _(w):
    """Registrations recorded 800 days late."""
    late = w.sources["users"].withColumn("created_at", F.col("created_at") + F.expr("interval 800 days"))
    shop = Warehouse({**w.sources, "users": late}, w.cfg)
    return invariants.invariant("first_order_not_before_registration", shop.frame, w.cfg)


@query("chk_cohort_full_retention_fires")
def _(w):
    """Cohort sizes one too high."""
    cohorts = w.mart_customer_cohorts
    size = F.col("cohort_customers") + 1
    wrong = cohorts.withColumn("retention_rate", money.ratio(F.col("active_customers"), size, 4))
    return invariants.invariant("cohort_starts_at_full_retention", lambda name: wrong, w.cfg)


@query("chk_ltv_unknown_not_zero_fires")
def _(w):
    """Customers none of whose lines have landed, with their unknown revenue read as zero in the average."""
    lost = w.sources["order_items"].where(F.col("user_id") % 20 != 0)
    shop = Warehouse({**w.sources, "order_items": lost}, w.cfg)
    read_as_zero = shop.dim_customers.withColumn(
        "avg_order_value", money.ratio(F.col("lifetime_net_revenue"), F.col("lifetime_orders"), 2)
    )
    return invariants.invariant("unknown_value_is_not_zero", lambda name: read_as_zero, w.cfg)


_add(
    # unknown revenue read as zero
    chk_incomplete_null_revenue_fires=lambda w: invariants.invariant(
        "incomplete_orders_have_null_revenue",
        _with(w, "fct_orders", net_revenue=F.coalesce("net_revenue", money.zero())),
        w.cfg,
    ),
    # a completeness flag that ignores missing items
    chk_completeness_invariant_fires=lambda w: invariants.invariant(
        "complete_orders_have_items", _with(w, "fct_orders", is_revenue_complete=F.lit(True)), w.cfg
    ),
    # two cents too much on every fifth unit
    chk_revenue_reconciles_fires=lambda w: invariants.invariant(
        "order_revenue_ties_to_items",
        _with(
            w,
            "fct_order_items",
            net_revenue=F.when(
                (F.col("order_item_id") % 5 == 0) & F.col("is_revenue_recognised"),
                (F.col("net_revenue") + F.lit("0.02").cast(money.MONEY)).cast(money.MONEY),
            ).otherwise(F.col("net_revenue")),
        ),
        w.cfg,
    ),
)


# metrics -----------------------------------------------------------------------------------------------------------
def _metric(name: str) -> Callable[[Sample], DataFrame]:
    return lambda w: metrics.metric_query(w.facts, [name], ["metric_time__month"])


_add(**{f"met_{name}": _metric(name) for name in metrics.METRICS})
_add(
    msr_cogs=_metric("cogs_measure"),
    msr_item_revenue=_metric("item_revenue_measure"),
    msr_item_units=_metric("item_units_measure"),
    msr_returned_units=_metric("returned_units_measure"),
    msr_line_items=_metric("line_item_measure"),
    mq_categorical=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "orders_placed"], ["order_status", "is_revenue_complete"]
    ),
    mq_entity_join=lambda w: metrics.metric_query(
        w.facts, ["repeat_purchase_rate", "order_count"], ["customer__traffic_source"]
    ),
    mq_two_hop=lambda w: metrics.metric_query(
        w.facts, ["item_revenue_measure", "line_item_measure"], ["order__customer__country", "department"],
        where=lambda d: d("order__order_status") != fixed.CANCELLED,
    ),
    mq_multi_metric=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "average_order_value", "registered_customers", "item_units_measure"],
        ["metric_time__quarter"],
    ),
    mq_ratio=lambda w: metrics.metric_query(
        w.facts, ["gross_margin_pct", "cancellation_rate", "return_rate"], ["metric_time__week"]
    ),
    mq_offset=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "net_revenue_mom_growth"], ["metric_time__month", "customer__country"]
    ),
    mq_offset_day=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "net_revenue_mom_growth"], ["metric_time__day"]
    ),
    mq_time_grain=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "order_count"], ["metric_time"], grains=dates.GRAINS
    ),
    # a distinct count in every grain, by a joined dimension
    mq_time_grain_customers=lambda w: metrics.metric_query(
        w.facts, ["purchasing_customers", "average_order_value"], ["metric_time", "customer__gender"], grains=dates.GRAINS
    ),
    mq_customer_segments=lambda w: metrics.metric_query(
        w.facts, ["registered_customers", "orders_placed", "lifetime_value_per_customer"],
        ["customer__customer_status", "customer__is_active", "customer__age_band"],
    ),
    mq_brand_status=lambda w: metrics.metric_query(
        w.facts, ["item_revenue_measure", "returned_units_measure"], ["brand", "item_status"]
    ),
    mq_cohort_quarter=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "purchasing_customers"], ["cohort_month__quarter", "is_first_purchase"]
    ),
    # every traffic source over the whole calendar, months without orders included
    mq_zero_fill_by_source=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "orders_placed", "average_order_value"], ["metric_time__month", "customer__traffic_source"],
        where=lambda d: d("customer__age_band") == fixed.AGE_BANDS[0][1], fill_zero=w.time_spine,
    ),
    mq_zero_fill=lambda w: metrics.metric_query(
        w.facts, ["net_revenue", "orders_placed"], ["metric_time"], grain="day", fill_zero=True
    ),
)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    return portable(QUERIES[name](Sample(spark, folder)))
