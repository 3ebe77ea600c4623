"""All models over one set of sources, lazily or as stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from tallywright.config import Config
from tallywright.operators import calendar, completeness, economics, history, joins, staging
from tallywright.plans import core, finance, marketing
from tallywright.session import run_folder, stored
from tallywright.sources.sinks import VersionedTable, write_clustered, write_month_partitioned, write_table

MARTS = (
    "fct_order_items",
    "fct_orders",
    "dim_products",
    "dim_customers",
    "fct_daily_revenue",
    "mart_product_performance",
    "mart_customer_cohorts",
    "mart_acquisition_channels",
)


class Warehouse:
    """Each model is a DataFrame built on first use.

    ``keep(name, df, finish)`` decides what a mart becomes for the models after it: the
    default leaves it lazy, ``build`` stores it; ``finish`` makes the mart's rows of those of
    ``df``, if they differ. ``measure`` looks for hot keys among
    the items before they are joined (one pass over the keys), so that the joins split them.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        cfg: Config = Config(),
        keep: Callable[..., DataFrame] | None = None,
        measure: bool = False,
    ):
        self.sources = dict(sources)
        self.cfg = cfg
        self._measure = measure
        self._stores = keep is not None
        self._keep = keep or (lambda name, df: df)

    # staging ---------------------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        return staging.stage_users(self.sources["users"], self.cfg)

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stage_orders(self.sources["orders"], self.cfg)

    @cached_property
    def order_items(self) -> DataFrame:
        return staging.stage_order_items(self.sources["order_items"], self.cfg)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stage_products(self.sources["products"])

    @cached_property
    def inventory_items(self) -> DataFrame:
        return staging.stage_inventory_items(self.sources["inventory_items"])

    @cached_property
    def distribution_centers(self) -> DataFrame:
        return staging.stage_distribution_centers(self.sources["distribution_centers"])

    @cached_property
    def events(self) -> DataFrame:
        return staging.stage_events(self.sources["events"], self.cfg)

    # intermediate ------------------------------------------------------------
    @cached_property
    def hot_keys(self) -> joins.HotKeys:
        return joins.hot_keys(self.order_items, "inventory_item_id", "product_id", "order_id") if self._measure else {}

    @cached_property
    def joined_items(self) -> DataFrame:
        return economics.join_items(self.order_items, self.inventory_items, self.products, self.hot_keys)

    @cached_property
    def enriched_items(self) -> DataFrame:
        return economics.split_items(self.joined_items)

    @cached_property
    def order_rollup(self) -> DataFrame:
        return economics.roll_up_orders(self.fct_order_items, self.hot_keys.get("order_id"))

    @cached_property
    def order_sums(self) -> DataFrame:
        return economics.sum_orders(self.fct_order_items)

    @cached_property
    def order_history(self) -> DataFrame:
        return history.order_history(self.orders, self.order_sums)

    @cached_property
    def boundary(self) -> DataFrame:
        return completeness.completeness_boundary(self.orders, self.order_items, self.cfg)

    @cached_property
    def as_of(self) -> DataFrame:
        return completeness.latest_order_date(self.orders)

    @cached_property
    def time_spine(self) -> DataFrame:
        return calendar.time_spine(self.sources["orders"].sparkSession, self.cfg)

    # marts -----------------------------------------------------------------
    @cached_property
    def fct_order_items(self) -> DataFrame:
        if not self._stores:
            return core.fct_order_items(self.enriched_items)
        # stored between the lookups and the layout: the widest shuffles of a build do not lie side by side
        return self._keep("fct_order_items", stored(self.joined_items, "joined-items"), economics.split_items)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._keep("fct_orders", core.fct_orders(self.orders, self.order_rollup, self.boundary))

    @cached_property
    def order_facts(self) -> DataFrame:
        """``fct_orders`` for models that ask nothing about an order's variety: of a stored mart the
        same rows, else without the two shuffles that counting categories and products takes."""
        if self._stores:
            return self.fct_orders.drop(*core.VARIETY_COLUMNS)
        return core.fct_orders(self.orders, self.order_sums, self.boundary)

    @cached_property
    def dim_products(self) -> DataFrame:
        stock = core.inventory_by_product(self.inventory_items)
        return self._keep("dim_products", core.dim_products(self.products, self.distribution_centers, stock))

    @cached_property
    def dim_customers(self) -> DataFrame:
        totals = core.customer_orders(self.order_facts)
        return self._keep("dim_customers", core.dim_customers(self.users, totals, self.as_of, self.cfg))

    @cached_property
    def fct_daily_revenue(self) -> DataFrame:
        daily = finance.daily_orders(self.order_facts)
        return self._keep("fct_daily_revenue", finance.fct_daily_revenue(daily))

    @cached_property
    def mart_product_performance(self) -> DataFrame:
        monthly = finance.product_month(self.fct_order_items)
        named = finance.with_product(monthly, self.dim_products)
        if self._stores:  # before they are ranked, so that the shuffles of either do not lie side by side
            named = stored(named, "named-months")
        return self._keep("mart_product_performance", finance.mart_product_performance(named, self.dim_products))

    @cached_property
    def product_ranks(self) -> DataFrame:
        return finance.product_ranks(self.fct_order_items, self.dim_products)

    @cached_property
    def cohort_activity(self) -> DataFrame:
        # order facts carry every column of the order history the cohorts need
        return marketing.cohort_activity(self.order_facts)

    @cached_property
    def mart_customer_cohorts(self) -> DataFrame:
        return self._keep("mart_customer_cohorts", marketing.mart_customer_cohorts(self.cohort_activity, self.cfg))

    @cached_property
    def mart_acquisition_channels(self) -> DataFrame:
        return self._keep("mart_acquisition_channels", marketing.mart_acquisition_channels(self.dim_customers))

    @cached_property
    def revenue_concentration(self) -> DataFrame:
        return marketing.revenue_concentration(self.dim_customers)

    def frame(self, name: str) -> DataFrame:
        """A source (``source.<table>``) or model by name."""
        if name.startswith("source."):
            return self.sources[name.removeprefix("source.")]
        return getattr(self, name)

    def facts(self, name: str) -> DataFrame:
        """``frame``, with ``order_facts`` in place of ``fct_orders``: for metrics and assertions."""
        return self.order_facts if name == "fct_orders" else self.frame(name)


#: physical layout: (date column for month partitions, cluster keys, table key)
LAYOUTS = {
    "fct_orders": ("ordered_date", ("order_status", "user_id"), ("order_id",)),
    "fct_order_items": ("ordered_date", ("category", "item_status"), ("order_item_id",)),
    "fct_daily_revenue": ("revenue_date", (), ("revenue_date",)),
    "dim_customers": (None, ("country", "customer_status"), ("user_id",)),
    "dim_products": (None, ("department", "category"), ("product_id",)),
}


#: columns of a mart that ``finish`` leaves among others
COLUMNS = {"fct_order_items": core.ITEM_COLUMNS}


def store_mart(
    name: str, df: DataFrame, folder: str, finish: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Write one mart in its layout as a new version under ``folder`` and read it back.

    ``finish`` goes with a layout by months (``write_month_partitioned``).
    """
    date_column, cluster_by, key = LAYOUTS.get(name, (None, (), ()))

    def write(path: str) -> DataFrame:
        if date_column:
            return write_month_partitioned(df, path, date_column, cluster_by, key, finish=finish)
        if cluster_by:
            return write_clustered(df, path, cluster_by, key)
        return write_table(df, path)

    columns = COLUMNS[name] if finish else df.columns
    return VersionedTable(df.sparkSession, f"{folder.rstrip('/')}/{name}").replace(write).select(*columns)


def build(sources: Mapping[str, DataFrame], cfg: Config, folder: str) -> Warehouse:
    """Build and store every mart; later marts read the stored earlier ones.

    A rebuild over an earlier one leaves that readable until each new mart is whole. What a mart
    stores on its way is removed when it is written.
    """
    warehouse = Warehouse(
        sources, cfg, keep=lambda name, df, finish=None: store_mart(name, df, folder, finish), measure=True
    )
    for name in MARTS:
        with run_folder(warehouse.sources["orders"].sparkSession):
            warehouse.frame(name)
    return warehouse
