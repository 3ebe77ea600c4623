"""Metrics defined once and computed over any time grain or dimension.

A semantic model describes one mart: its time column, entities (join keys),
dimensions and measures. ``metric_query`` aggregates each model that a query needs
once and puts the results side by side, one row per group.

Facts are aggregated before they meet a dimension: by the join key and whatever else
the query needs of them, and again after each join, so a join sees a row per group,
not per fact. A distinct count keeps the counted value among the groups until the end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.functions.dates import GRAINS, truncate
from tallywright.functions.money import total
from tallywright.operators.completeness import with_one_row


@dataclass(frozen=True)
class Measure:
    """``agg`` is "sum", "total" (of money) or "count_distinct"."""

    expr: Callable[[], Column]
    agg: str = "sum"

    def merge(self, name: str) -> Column:
        """The aggregate over rows, or over partial results, that hold the measure in column ``name``."""
        aggregates = {"sum": F.sum, "total": total, "count_distinct": F.countDistinct}
        return aggregates[self.agg](F.col(name)).alias(name)


def _amount(name: str) -> Measure:
    return Measure(lambda: F.col(name), "total")


def _number(name: str) -> Measure:
    return Measure(lambda: F.col(name))


def _flag(name: str) -> Measure:
    return Measure(lambda: F.when(F.col(name), 1).otherwise(0))


def _rows() -> Measure:
    return Measure(lambda: F.lit(1))


@dataclass(frozen=True)
class Model:
    mart: str
    time: str
    primary: tuple[str, str]
    foreign: Mapping[str, str] = field(default_factory=dict)
    time_dimensions: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    measures: Mapping[str, Measure] = field(default_factory=dict)

    def has(self, dimension: str) -> bool:
        return dimension in self.time_dimensions or dimension in self.categorical


@dataclass(frozen=True)
class Metric:
    """Simple (a measure), ratio (two metrics) or growth (metric and month offset)."""

    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    growth_of: str | None = None
    offset_months: int = 1


MODELS: dict[str, Model] = {
    "orders": Model(
        mart="fct_orders",
        time="ordered_date",
        primary=("order", "order_id"),
        foreign={"customer": "user_id"},
        time_dimensions=("ordered_date", "cohort_month"),
        categorical=(
            "order_status",
            "is_revenue_recognised",
            "is_revenue_complete",
            "is_first_purchase",
            "is_repeat_purchase",
        ),
        measures={
            "net_revenue_measure": _amount("net_revenue"),
            "gross_profit_measure": _amount("net_gross_profit"),
            "cogs_measure": _amount("net_cogs"),
            "order_count_measure": _flag("is_revenue_recognised"),
            "orders_placed_measure": _rows(),
            "cancelled_order_measure": _flag("is_cancelled"),
            "returned_order_measure": _flag("is_returned"),
            "repeat_order_measure": _flag("is_repeat_purchase"),
            "purchasing_customers_measure": Measure(lambda: F.col("user_id"), "count_distinct"),
            "units_sold_measure": _number("units_sold"),
        },
    ),
    "customers": Model(
        mart="dim_customers",
        time="registered_date",
        primary=("customer", "user_id"),
        time_dimensions=("registered_date", "cohort_month"),
        categorical=("traffic_source", "country", "age_band", "gender", "customer_status", "is_active"),
        measures={
            "customer_count_measure": _rows(),
            "active_customer_measure": _flag("is_active"),
            "purchased_customer_measure": _flag("has_purchased"),
            "repeat_customer_measure": _flag("is_repeat_customer"),
            "lifetime_revenue_measure": _amount("lifetime_net_revenue"),
        },
    ),
    "order_items": Model(
        mart="fct_order_items",
        time="ordered_date",
        primary=("order_item", "order_item_id"),
        foreign={"order": "order_id", "product": "product_id"},
        time_dimensions=("ordered_date",),
        categorical=("category", "department", "brand", "item_status"),
        measures={
            "item_revenue_measure": _amount("net_revenue"),
            "item_units_measure": _number("net_units"),
            "returned_units_measure": _flag("is_returned"),
            "line_item_measure": _rows(),
        },
    ),
}

METRICS: dict[str, Metric] = {
    # revenue
    "net_revenue": Metric(measure="net_revenue_measure"),
    "gross_profit": Metric(measure="gross_profit_measure"),
    "gross_margin_pct": Metric(numerator="gross_profit", denominator="net_revenue"),
    "net_revenue_mom_growth": Metric(growth_of="net_revenue"),
    # volume
    "order_count": Metric(measure="order_count_measure"),
    "orders_placed": Metric(measure="orders_placed_measure"),
    "units_sold": Metric(measure="units_sold_measure"),
    "average_order_value": Metric(numerator="net_revenue", denominator="order_count"),
    # reliability
    "cancelled_orders": Metric(measure="cancelled_order_measure"),
    "returned_orders": Metric(measure="returned_order_measure"),
    "cancellation_rate": Metric(numerator="cancelled_orders", denominator="orders_placed"),
    "return_rate": Metric(numerator="returned_orders", denominator="orders_placed"),
    # customers
    "repeat_orders": Metric(measure="repeat_order_measure"),
    "purchasing_customers": Metric(measure="purchasing_customers_measure"),
    "repeat_purchase_rate": Metric(numerator="repeat_orders", denominator="order_count"),
    "registered_customers": Metric(measure="customer_count_measure"),
    "purchasing_customers_lifetime": Metric(measure="purchased_customer_measure"),
    "repeat_customers": Metric(measure="repeat_customer_measure"),
    "repeat_customer_rate": Metric(numerator="repeat_customers", denominator="purchasing_customers_lifetime"),
    "conversion_rate": Metric(numerator="purchasing_customers_lifetime", denominator="registered_customers"),
    "active_customers": Metric(measure="active_customer_measure"),
    "lifetime_revenue": Metric(measure="lifetime_revenue_measure"),
    "lifetime_value_per_customer": Metric(numerator="lifetime_revenue", denominator="purchasing_customers_lifetime"),
}

_MEASURE_MODEL = {measure: name for name, model in MODELS.items() for measure in model.measures}
_PRIMARY_MODEL = {model.primary[0]: name for name, model in MODELS.items()}


def _measures_of(name: str) -> set[str]:
    """Measures a metric (or a bare measure) needs."""
    if name in _MEASURE_MODEL:
        return {name}
    if name not in METRICS:
        raise KeyError(f"unknown metric {name!r}")
    metric = METRICS[name]
    if metric.measure:
        return {metric.measure}
    parts = [p for p in (metric.numerator, metric.denominator, metric.growth_of) if p]
    return set().union(*(_measures_of(p) for p in parts))


@dataclass
class _Lookup:
    """A join to the one row of another model that a key refers to."""

    model: Model
    key: str  # the state column that refers to it
    columns: dict[str, Column] = field(default_factory=dict)  # state column -> expression over its mart


class _Grouping:
    """Resolves dimension names on one model, and aggregates the model by them.

    Every name becomes a state column of that name, computed on the mart that has it.
    """

    def __init__(self, frames: Callable[[str], DataFrame], model_name: str, grain: str | None):
        self.frames = frames
        self.model = MODELS[model_name]
        self.grain = grain
        self.local: dict[str, Column] = {}
        self.lookups: dict[str, _Lookup] = {}  # by path, nearer ones first

    def __call__(self, name: str) -> Column:
        head, _, suffix = name.rpartition("__")
        grain = suffix if head and suffix in GRAINS else None
        path = (head if grain else name).split("__")
        if path == ["metric_time"]:
            self.local[name] = truncate(F.col(self.model.time), grain or self.grain or "day")
        else:
            self._resolve(name, path, grain)
        return F.col(name)

    def _resolve(self, name: str, path: Sequence[str], grain: str | None) -> None:
        *entities, dimension = path
        model, columns, prefix = self.model, self.local, ""
        for entity in entities:
            if entity == model.primary[0]:
                continue
            if entity not in model.foreign or entity not in _PRIMARY_MODEL:
                raise KeyError(f"no path to {'__'.join(path)!r} from {self.model.mart}")
            prefix = f"{prefix}{entity}__"
            if prefix not in self.lookups:
                columns[f"_{prefix}key"] = F.col(model.foreign[entity])
                self.lookups[prefix] = _Lookup(MODELS[_PRIMARY_MODEL[entity]], f"_{prefix}key")
            model, columns = self.lookups[prefix].model, self.lookups[prefix].columns
        if not model.has(dimension):
            raise KeyError(f"{model.mart} has no dimension {dimension!r}")
        columns[name] = F.col(dimension)
        if dimension in model.time_dimensions:
            default = self.grain if dimension == model.time and not entities else None
            columns[name] = truncate(F.col(dimension), grain or default or "day")

    def states(self, measures: Sequence[str], condition: Column | None) -> DataFrame:
        """Rows that fulfil the condition, with the resolved columns and the measures; partly
        aggregated where dimensions had to be joined."""
        inputs = {m: self.model.measures[m].expr() for m in measures}
        rows = self.frames(self.model.mart).select(*(c.alias(n) for n, c in (self.local | inputs).items()))
        held = list(self.local)
        for lookup in self.lookups.values():
            rows = self.merged(rows, held, measures)
            own_key = f"{lookup.key}_"
            other = self.frames(lookup.model.mart).select(
                F.col(lookup.model.primary[1]).alias(own_key), *(c.alias(n) for n, c in lookup.columns.items())
            )
            rows = rows.join(other, F.col(lookup.key) == F.col(own_key), "left").drop(lookup.key, own_key)
            held = [n for n in held if n != lookup.key] + list(lookup.columns)
        return rows if condition is None else rows.where(condition)

    def merged(self, rows: DataFrame, groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Partial results by group; values to be counted distinct stay groups."""
        counted = [m for m in measures if self.model.measures[m].agg == "count_distinct"]
        sums = [self.model.measures[m].merge(m) for m in measures if m not in counted]
        keyed = rows.groupBy(*groups, *counted)
        return keyed.agg(*sums) if sums else rows.select(*groups, *counted).distinct()

    def final(self, rows: DataFrame, groups: Sequence[str], measures: Sequence[str]) -> DataFrame:
        return rows.groupBy(*groups).agg(*(self.model.measures[m].merge(m) for m in measures))


def fill_periods(
    df: DataFrame,
    period: str,
    grain: str,
    values: Sequence[str],
    groups: Sequence[str] = (),
    first: Column | None = None,
    last: Column | None = None,
) -> DataFrame:
    """Insert the missing periods of each group, values as zero; rows that are there stay as they are.

    Each row emits the periods up to the next one of its group; with ``first`` and ``last``
    the group's first row also emits those before it and its last row those after
    it, so every group, the null one included, covers exactly that range. No calendar is
    joined, and a window sees one group's periods.
    """
    step = {"day": "1 day", "week": "7 day", "month": "1 month", "quarter": "3 month", "year": "1 year"}[grain]
    timeline = Window.partitionBy(*groups).orderBy(period)
    at = F.col(period)
    placed = df.withColumns({"_next": F.lead(period).over(timeline), "_before": F.lag(period).over(timeline)})
    begin, end = at, F.coalesce(F.col("_next"), at)
    if first is not None:
        first = truncate(first, grain)
        begin = F.greatest(first, F.when(F.col("_before").isNull(), F.least(first, at)).otherwise(at))
    if last is not None:
        last = truncate(last, grain)
        end = F.least(last, F.coalesce(F.col("_next"), F.greatest(last, at)))
    periods = F.when(begin <= end, F.sequence(begin, end, F.expr(f"interval {step}")))
    emitted = F.filter(periods, lambda d: F.col("_next").isNull() | (d < F.col("_next")))
    spread = placed.withColumn("_at", F.explode(emitted))
    return spread.select(
        F.col("_at").alias(period),
        *groups,
        *(F.when(F.col("_at") == at, F.col(v)).otherwise(F.lit(0)).alias(v) for v in values),
    )


def _divide(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def metric_query(
    frames: Callable[[str], DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    grain: str | None = None,
    where: Callable[[Callable[[str], Column]], Column] | None = None,
    fill_zero: bool | tuple[date, date] | DataFrame = False,
    grains: Sequence[str] = (),
) -> DataFrame:
    """Metrics (or measures) by dimensions, one row per group.

    ``frames`` returns a mart by name. Group names are local dimensions
    (``order_status``), dimensions of a joined model (``customer__country``,
    ``order__customer__country``) or ``metric_time``, the model's own time column;
    time names take a grain suffix (``metric_time__month``) or ``grain``.
    ``where`` receives the same resolver: ``lambda d: d("customer__country") == "x"``.
    Ratios divide the aggregates of the group, never average row ratios.

    ``grains`` asks for several grains of ``metric_time`` at once, told apart by a column
    ``grain``: the facts are aggregated once by day, and all grains come from the days.

    ``fill_zero`` inserts missing periods with measures 0 and ratios null: True between a
    group's own periods, a pair of dates or a time spine (its ``date_day``) over that range.
    """
    needed = sorted(set().union(*(_measures_of(m) for m in metrics)))
    growth = [METRICS[m] for m in metrics if m in METRICS and METRICS[m].growth_of]
    if grains and ("metric_time" not in group_by or grain or growth or fill_zero):
        raise ValueError("grains need a plain metric_time, and neither growth nor fill_zero")
    groups = ["grain", *group_by] if grains else list(group_by)
    parts: list[DataFrame] = []
    for model_name in dict.fromkeys(_MEASURE_MODEL[m] for m in needed):
        resolve = _Grouping(frames, model_name, grain)
        for name in group_by:
            resolve(name)
        condition = where(resolve) if where else None
        measures = [m for m in needed if _MEASURE_MODEL[m] == model_name]
        rows = resolve.states(measures, condition)
        if grains:
            rows = _in_grains(resolve.merged(rows, group_by, measures), grains)
        parts.append(resolve.final(rows, groups, measures))

    result = parts[0]
    if len(parts) > 1:
        # stacking and regrouping lines up null keys too, which a join would not
        for other in parts[1:]:
            result = result.unionByName(other, allowMissingColumns=True)
        result = result.groupBy(*groups).agg(*(F.max(m).alias(m) for m in needed))

    filled = not isinstance(fill_zero, bool) or fill_zero
    if filled:
        result = _filled(result, group_by, grain, needed, fill_zero)
    for metric in growth:
        result = _with_prior(result, group_by, grain, metric)

    def value(name: str) -> Column:
        # an unknown amount is shown as 0 too, but a ratio of it stays unknown
        plain = name in _MEASURE_MODEL or METRICS[name].measure
        return F.coalesce(_value(name), F.lit(0)) if filled and plain else _value(name)

    return result.select(*groups, *(value(m).alias(m) for m in metrics))


def _in_grains(days: DataFrame, grains: Sequence[str]) -> DataFrame:
    """Each day's states once for every grain, at the start of its period."""
    periods = F.array(
        *(F.struct(F.lit(g).alias("grain"), truncate(F.col("metric_time"), g).alias("start")) for g in grains)
    )
    rest = [c for c in days.columns if c != "metric_time"]
    spread = days.select(F.explode(periods).alias("period"), *rest)
    return spread.select(F.col("period.grain").alias("grain"), F.col("period.start").alias("metric_time"), *rest)


def _filled(
    result: DataFrame, group_by: Sequence[str], grain: str | None, needed: Sequence[str], over: bool | tuple[date, date] | DataFrame
) -> DataFrame:
    times = [g for g in group_by if g.partition("__")[0] == "metric_time"]
    if len(times) != 1:
        raise ValueError("fill_zero needs metric_time once among the groups")
    (time,), groups = times, [g for g in group_by if g not in times]
    unit = time.partition("__")[2] or grain or "day"
    if over is True:
        return fill_periods(result, time, unit, needed, groups)
    if isinstance(over, DataFrame):
        result = with_one_row(result, over.agg(F.min("date_day").alias("_first"), F.max("date_day").alias("_last")))
        first, last = F.col("_first"), F.col("_last")
    else:
        first, last = map(F.lit, over)
    return fill_periods(result, time, unit, needed, groups, first, last)


def _value(name: str) -> Column:
    if name in _MEASURE_MODEL:
        return F.col(name)
    metric = METRICS[name]
    if metric.measure:
        return F.col(metric.measure)
    if metric.growth_of:
        current, prior = _value(metric.growth_of).cast("double"), F.col(f"_prior_{metric.growth_of}").cast("double")
        return F.try_divide(current - prior, prior)
    return _divide(_value(metric.numerator), _value(metric.denominator))


def _with_prior(result: DataFrame, group_by: Sequence[str], grain: str | None, metric: Metric) -> DataFrame:
    """Adds the metric's value of the period a calendar offset earlier.

    The earlier period is looked up from each row, since one day may be the month
    before several (the end of a short month). Both sides are the aggregated frame,
    one row per group; null keys match.
    """
    times = [g for g in group_by if g.partition("__")[0] == "metric_time"]
    if len(times) != 1:
        raise ValueError("growth needs metric_time once among the groups")
    time, prior = times[0], f"_prior_{metric.growth_of}"
    unit = time.partition("__")[2] or grain or "day"
    earlier = F.add_months(time, -metric.offset_months)
    if unit != "day":
        earlier = F.date_trunc(unit, earlier).cast("date")
    elsewhere = result.select(
        *(F.col(g).alias(f"_{g}") for g in group_by), _value(metric.growth_of).cast("decimal(38,2)").alias(prior)
    )
    matches = [
        (earlier if g == time else F.col(g)).eqNullSafe(F.col(f"_{g}")) for g in group_by
    ]
    return result.join(elsewhere, matches, "left").drop(*(f"_{g}" for g in group_by))
