"""Generic data checks: every check returns its violations, empty means pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def restrict(df: DataFrame, where: str | Column | None) -> DataFrame:
    """The part of the frame a conditional check looks at."""
    return df if where is None else df.where(where)


def duplicates(df: DataFrame, *keys: str, where: str | Column | None = None) -> DataFrame:
    """Key values that occur more than once. A single key ignores nulls."""
    rows = restrict(df, where)
    if len(keys) == 1:
        rows = rows.where(F.col(keys[0]).isNotNull())
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def null_rule(column: str) -> Column:
    return F.col(column).isNull()


def value_rule(column: str, accepted: Iterable[object]) -> Column:
    """True for a value outside the list; nulls pass."""
    return ~F.col(column).isin(*accepted)


def range_rule(
    column: str, min_value: float | None = None, max_value: float | None = None, inclusive: bool = True
) -> Column:
    """True for a value outside the range; nulls pass."""
    c = F.col(column)
    broken = F.lit(False)
    if min_value is not None:
        broken = broken | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        broken = broken | ((c > max_value) if inclusive else (c >= max_value))
    return broken


def violations(df: DataFrame, rule: Column, where: str | Column | None = None) -> DataFrame:
    return restrict(df, where).where(rule)


def orphans(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, where: str | Column | None = None
) -> DataFrame:
    """Foreign key values without a parent row, and how many rows carry each.

    The child is counted per key before the join, so a key that fills the table
    reaches it as one row.
    """
    counted = (
        restrict(child, where)
        .where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("key"))
    return counted.join(known, "key", "left_anti")


def failures_by_rule(df: DataFrame, rules: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Counts many ``(label, row rule)`` pairs in one pass: ``label, failures``."""
    counts = df.agg(*(F.count_if(rule).alias(f"r{i}") for i, (_, rule) in enumerate(rules)))
    pairs = F.array(
        *(F.struct(label.alias("label"), F.col(f"r{i}").alias("failures")) for i, (label, _) in enumerate(rules))
    )
    return counts.select(F.inline(pairs))
