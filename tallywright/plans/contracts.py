"""Declared data contracts of sources, staging and marts, and the check report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.config import Config
from tallywright.functions import fixed_values as fixed
from tallywright.operators import checks
from tallywright.plans.invariants import FRAME_INVARIANTS, ROW_INVARIANTS, invariant
from tallywright.session import stored

_LABELS = {
    "age_band": tuple(label for _, label in fixed.AGE_BANDS),
    "price_tier": tuple(label for _, label in fixed.PRICE_TIERS),
}


@dataclass(frozen=True)
class Contract:
    check: str  # unique, not_null, accepted_values, accepted_range, relationships, unique_combination
    table: str
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    parent: str = ""
    parent_key: str = ""
    where: str | None = None
    severity: str = "error"

    @property
    def column(self) -> str:
        return ", ".join(self.columns)

    def row_rule(self) -> Column | None:
        """The violating condition, for checks that look at one row at a time."""
        if self.check == "not_null":
            return checks.null_rule(self.columns[0])
        if self.check == "accepted_values":
            return checks.value_rule(self.columns[0], self.values)
        if self.check == "accepted_range":
            return checks.range_rule(self.columns[0], self.min_value, self.max_value, self.inclusive)
        return None

    def violations(self, frames: Callable[[str], DataFrame]) -> DataFrame:
        df = frames(self.table)
        rule = self.row_rule()
        if rule is not None:
            return checks.violations(df, rule, self.where)
        if self.check == "relationships":
            return checks.orphans(df, self.columns[0], frames(self.parent), self.parent_key, self.where)
        return checks.duplicates(df, *self.columns, where=self.where)


def _key(table: str, column: str) -> list[Contract]:
    return [Contract("unique", table, (column,)), Contract("not_null", table, (column,))]


def _not_null(table: str, *columns: str, where: str | None = None) -> list[Contract]:
    return [Contract("not_null", table, (c,), where=where) for c in columns]


def _values(table: str, column: str, values: Iterable[str]) -> list[Contract]:
    return [Contract("accepted_values", table, (column,), values=tuple(values))]


def _range(table: str, column: str, low=None, high=None, inclusive=True, where=None, severity="error") -> list[Contract]:
    return [
        Contract(
            "accepted_range", table, (column,), min_value=low, max_value=high, inclusive=inclusive, where=where,
            severity=severity,
        )
    ]


def _refers(table: str, column: str, parent: str, parent_key: str) -> list[Contract]:
    return [Contract("relationships", table, (column,), parent=parent, parent_key=parent_key)]


def _grain(table: str, *columns: str) -> list[Contract]:
    return [Contract("unique_combination", table, columns)]


SOURCE_CONTRACTS = [
    *_key("source.users", "id"),
    *_key("source.orders", "order_id"),
    *_not_null("source.orders", "user_id"),
    *_refers("source.orders", "user_id", "source.users", "id"),
    *_values("source.orders", "status", fixed.ORDER_STATUSES),
    *_key("source.order_items", "id"),
    *_not_null("source.order_items", "order_id"),
    *_refers("source.order_items", "order_id", "source.orders", "order_id"),
    *_refers("source.order_items", "product_id", "source.products", "id"),
    *_key("source.products", "id"),
    *_key("source.inventory_items", "id"),
    *_key("source.distribution_centers", "id"),
    *_key("source.events", "id"),
]

STAGING_CONTRACTS = [
    *_key("users", "user_id"),
    *_not_null("users", "email", "registered_at"),
    *_values("users", "age_band", _LABELS["age_band"]),
    *_values("users", "gender", fixed.GENDERS),
    *_key("orders", "order_id"),
    *_not_null("orders", "user_id", "order_status"),
    *_refers("orders", "user_id", "users", "user_id"),
    *_values("orders", "order_status", fixed.ORDER_STATUSES),
    *_range("orders", "items_ordered", low=1),
    *_range("orders", "days_to_ship", low=0, where="days_to_ship is not null"),
    *_key("order_items", "order_item_id"),
    *_not_null("order_items", "order_id", "product_id", "sale_price"),
    *_refers("order_items", "order_id", "orders", "order_id"),
    *_refers("order_items", "product_id", "products", "product_id"),
    *_refers("order_items", "inventory_item_id", "inventory_items", "inventory_item_id"),
    *_range("order_items", "sale_price", low=0),
    *_values("order_items", "item_status", fixed.ORDER_STATUSES),
    *_key("products", "product_id"),
    *_not_null("products", "sku", "category"),
    *_values("products", "department", fixed.DEPARTMENTS),
    *_range("products", "list_price", low=0, inclusive=False),
    *_range("products", "list_margin_pct", low=-1, high=1, where="list_margin_pct is not null"),
    *_key("inventory_items", "inventory_item_id"),
    *_not_null("inventory_items", "product_id", "unit_cost"),
    *_refers("inventory_items", "product_id", "products", "product_id"),
    *_range("inventory_items", "unit_cost", low=0),
    *_key("distribution_centers", "distribution_center_id"),
    *_key("distribution_centers", "distribution_center_name"),
    *_key("events", "event_id"),
    *_not_null("events", "event_type", "session_id"),
]

MART_CONTRACTS = [
    *_key("fct_orders", "order_id"),
    *_not_null(
        "fct_orders", "user_id", "is_revenue_recognised", "has_line_items", "is_revenue_complete", "ordered_date"
    ),
    *_refers("fct_orders", "user_id", "dim_customers", "user_id"),
    *_values("fct_orders", "order_status", fixed.ORDER_STATUSES),
    *_not_null("fct_orders", "net_revenue", where="is_revenue_complete"),
    *_range("fct_orders", "net_revenue", low=0),
    *_key("fct_order_items", "order_item_id"),
    *_not_null("fct_order_items", "order_id"),
    *_refers("fct_order_items", "order_id", "fct_orders", "order_id"),
    *_refers("fct_order_items", "product_id", "dim_products", "product_id"),
    *_range("fct_order_items", "net_revenue", low=0),
    *_range(
        "fct_order_items", "net_margin_pct", low=-5, high=1, where="net_margin_pct is not null", severity="warn"
    ),
    *_key("dim_customers", "user_id"),
    *_not_null(
        "dim_customers",
        "customer_status",
        "lifetime_net_revenue",
        "lifetime_orders",
        "lifetime_incomplete_orders",
        "has_incomplete_orders",
        "lifetime_orders_missing_economics",
    ),
    *_values("dim_customers", "customer_status", fixed.CUSTOMER_STATUSES),
    *_range("dim_customers", "lifetime_net_revenue", low=0),
    *_range("dim_customers", "lifetime_orders", low=0),
    *_range("dim_customers", "avg_order_value", low=0, inclusive=False, where="avg_order_value is not null"),
    *_key("dim_products", "product_id"),
    *_not_null("dim_products", "sku"),
    *_values("dim_products", "price_tier", _LABELS["price_tier"]),
    *_range("dim_products", "sell_through_rate", low=0, high=1, where="sell_through_rate is not null"),
    *_key("fct_daily_revenue", "revenue_date"),
    *_not_null("fct_daily_revenue", "is_revenue_complete", "net_revenue"),
    *_range("fct_daily_revenue", "gross_margin_pct", low=-1, high=1, where="gross_margin_pct is not null"),
    *_range("fct_daily_revenue", "cancellation_rate", low=0, high=1, where="cancellation_rate is not null"),
    *_grain("mart_product_performance", "revenue_month", "product_id"),
    *_not_null("mart_product_performance", "product_id", "revenue_month"),
    *_grain("mart_customer_cohorts", "cohort_month", "months_since_first_purchase"),
    *_not_null("mart_customer_cohorts", "cohort_month", "cohort_customers"),
    *_range("mart_customer_cohorts", "retention_rate", low=0, high=1),
    *_range("mart_customer_cohorts", "cohort_customers", low=1),
    *_grain("mart_acquisition_channels", "registration_month", "traffic_source"),
    *_range("mart_acquisition_channels", "conversion_rate", low=0, high=1),
    *_not_null("mart_acquisition_channels", "customers_acquired"),
]

SPINE_CONTRACTS = [*_key("time_spine", "date_day")]

CONTRACTS: list[Contract] = [*SOURCE_CONTRACTS, *STAGING_CONTRACTS, *MART_CONTRACTS, *SPINE_CONTRACTS]


def _label(check: str, table: str, column: str, severity: str) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(severity).alias("severity"),
    )


def _contract_label(contract: Contract) -> Column:
    return _label(contract.check, contract.table, contract.column, contract.severity)


def _by_number(counted: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """Turn ``number, failures`` into labelled rows, 0 for checks without any."""
    labels = F.array(*(_contract_label(c) for c in contracts))
    numbers = counted.sparkSession.range(len(contracts)).select(F.col("id").cast("int").alias("number"))
    return numbers.join(counted, "number", "left").select(
        F.get(labels, F.col("number")).alias("label"), F.coalesce("failures", F.lit(0)).alias("failures")
    ).select("label.*", "failures")


def key_failures(frames: Callable[[str], DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """Duplicate keys per uniqueness check: the keys of all tables share one shuffle."""

    def keys(number: int, contract: Contract) -> DataFrame:
        rows = checks.restrict(frames(contract.table), contract.where)
        whole, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        if len(contract.columns) > 1:
            text = F.to_json(F.struct(*contract.columns))
        else:
            key = F.col(contract.columns[0])
            rows = rows.where(key.isNotNull())
            if _is_whole(rows, contract.columns[0]):
                whole = key.cast("bigint")
            else:
                text = key.cast("string")
        return rows.select(F.lit(number).alias("number"), whole.alias("whole"), text.alias("text"))

    stacked = reduce(DataFrame.unionByName, [keys(i, c) for i, c in enumerate(contracts)])
    repeated = stacked.groupBy("number", "whole", "text").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    return _by_number(repeated.groupBy("number").agg(F.count("*").alias("failures")), contracts)


def _is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _lost_keys(frames: Callable[[str], DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """``number, key, n_rows``: keys without a parent for each reference, in one shuffle of all.

    Children are counted per key first, so a key that fills a table is one row. A parent's key
    marks its group: no join, and a key that many rows carry is combined on both sides. Each table
    is read once, for all references that it makes and all that it answers.
    """
    whole = all(
        _is_whole(frames(c.table), c.columns[0]) and _is_whole(frames(c.parent), c.parent_key) for c in contracts
    )
    kind = "bigint" if whole else "string"
    sides: dict[str, list[Column]] = {}

    def side(table: str, number: int, key: Column, child: int) -> None:
        sides.setdefault(table, []).append(F.struct(
            F.lit(number).alias("number"), key.cast(kind).alias("key"), F.lit(child).alias("child"), F.lit(1 - child).alias("parent")
        ))

    for number, contract in enumerate(contracts):
        key = F.col(contract.columns[0])
        side(contract.table, number, key if contract.where is None else F.when(F.expr(contract.where), key), 1)
        side(contract.parent, number, F.col(contract.parent_key), 0)

    stacked = [frames(table).select(F.inline(F.array(*keys))) for table, keys in sides.items()]
    met = reduce(DataFrame.unionByName, stacked).where("key is not null").groupBy("number", "key").agg(
        F.sum("child").alias("n_rows"), F.max("parent").alias("known")
    )
    return met.where("known = 0").select("number", "key", "n_rows")


def lost_references(frames: Callable[[str], DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """Every key without a parent row, and how many rows carry it, by table and column."""
    names = F.array(*(F.struct(F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name")) for c in contracts))
    lost = _lost_keys(frames, contracts)
    return lost.select(F.get(names, F.col("number")).alias("name"), "key", "n_rows").select("name.*", "key", "n_rows")


def reference_failures(frames: Callable[[str], DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """Rows without a parent per reference check."""
    lost = _lost_keys(frames, contracts)
    return _by_number(lost.groupBy("number").agg(F.sum("n_rows").alias("failures")), contracts)


def row_failures(
    frames: Callable[[str], DataFrame], rules: Sequence[tuple[str, Column, Column]]
) -> DataFrame:
    """Counts of ``(table, label, rule)``, one pass per table for all its rules."""
    by_table: dict[str, list[tuple[Column, Column]]] = {}
    for table, label, rule in rules:
        by_table.setdefault(table, []).append((label, rule))
    parts = [
        checks.failures_by_rule(frames(table), group).select("label.*", "failures")
        for table, group in by_table.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def run_report(
    frames: Callable[[str], DataFrame], cfg: Config, contracts: Sequence[Contract] = tuple(CONTRACTS)
) -> DataFrame:
    """Every contract and assertion with its failures and status.

    The parts are counted one after another, when the report is asked for: the shuffles of one are gone
    before the next makes its own.
    """
    rules = [
        (c.table, _contract_label(c), rule if c.where is None else F.expr(c.where) & rule)
        for c in contracts
        if (rule := c.row_rule()) is not None
    ]
    rules += [(mart, _label(name, mart, "", "error"), rule(cfg)) for name, (mart, rule, _) in ROW_INVARIANTS.items()]
    parts = [row_failures(frames, rules)]

    unique = [c for c in contracts if c.check in ("unique", "unique_combination")]
    references = [c for c in contracts if c.check == "relationships"]
    if unique:
        parts.append(key_failures(frames, unique))
    if references:
        parts.append(reference_failures(frames, references))
    for name, mart in FRAME_INVARIANTS.items():
        counted = invariant(name, frames, cfg).agg(F.count("*").alias("failures"))
        parts.append(counted.select(_label(name, mart, "", "error").alias("label"), "failures").select("label.*", "failures"))

    return reduce(DataFrame.unionByName, [stored(part, "failures") for part in parts]).withColumn(
        "status",
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"),
    )
