"""Running sums within groups that no single task has to hold.

A window over a group gathers the group. Here the rows are range-partitioned by
group and order, so that a large group lies in several partitions. Each partition
is summed by itself; what its earlier partitions hold of the same group is carried
over from one narrow row per (partition, group).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.session import stored

_TERM = re.compile(r"^(?:Column<')?`?(\w+)`?(?: (ASC|DESC))?(?: NULLS (FIRST|LAST))?(?:'>)?$", re.IGNORECASE)


@dataclass(frozen=True)
class Term:
    """One sort key: a column of the frame and its direction."""

    name: str
    descending: bool
    nulls_last: bool

    def column(self, name: str | None = None) -> Column:
        c = F.col(name or self.name)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()

    def comes_after(self, value: Column) -> Column:
        """Whether the row's key sorts after ``value``; never null."""
        c = F.col(self.name)
        beyond = (c < value) if self.descending else (c > value)
        with_null = (c.isNull() & value.isNotNull()) if self.nulls_last else (c.isNotNull() & value.isNull())
        return F.coalesce(beyond, F.lit(False)) | with_null


def sort_terms(order_by: Sequence[Column | str]) -> list[Term]:
    """Sort keys given as columns (``F.col("x").desc()``) or text (``"x DESC"``)."""
    terms = []
    for key in order_by:
        found = _TERM.match(str(key))
        if not found:
            raise ValueError(f"sort by a plain column, not {key}")
        name, direction, nulls = found.groups()
        descending = (direction or "").upper() == "DESC"
        terms.append(Term(name, descending, descending if nulls is None else nulls.upper() == "LAST"))
    return terms


def prefix_sums(
    rows: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[Column | str],
    sums: Mapping[str, Column],
    whole: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Adds running sums up to each row within its group, the row included.

    ``whole`` adds aggregates (min, max) over the entire group. Null group values
    are a group like any other. The rows are stored once: pass a narrow frame. The
    sort key must be unique within a group. Windows see one partition's part of a group,
    or one row per partition of it.
    """
    whole = dict(whole or {})
    placed = _placed(rows, groups, order_by)
    parts = placed.groupBy("_group", "_part").agg(
        *(F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()),
        *(c.alias(f"_part_{name}") for name, c in whole.items()),
    )
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("_group")
    carried = parts.select(
        "_group",
        "_part",
        *(F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in sums),
        *(_again(c)(F.col(f"_part_{name}")).over(every).alias(name) for name, c in whole.items()),
    )
    inside = Window.partitionBy("_group", "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumns({f"_sum_{name}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for name, c in sums.items()})
    return running.join(carried, ["_group", "_part"]).select(
        *rows.columns,
        *((F.col(f"_before_{name}") + F.col(f"_sum_{name}")).alias(name) for name in sums),
        *whole,
    )


def _placed(rows: DataFrame, groups: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The rows ranged by group and order and stored, with their partition and their place in it."""
    keys = [F.col(g).asc_nulls_first() for g in groups] + [term.column() for term in sort_terms(order_by)]
    # a struct is never null, and equal structs may hold nulls
    group = F.struct(*(F.col(g) for g in groups)) if groups else F.struct(F.lit(0).alias("all"))
    return stored(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "placed",
    ).withColumn("_group", group)


def row_numbers(rows: DataFrame, groups: Sequence[str], order_by: Sequence[Column | str], name: str) -> DataFrame:
    """Adds the 1-based number of each row within its group.

    As ``prefix_sums`` with a sum of ones, but without a window over the rows: those of a group
    stand side by side in a partition, so a number is the place less that of the group's first
    row there. These first places are stored, so that Spark knows their size when it joins them.
    """
    placed = _placed(rows, groups, order_by)
    parts = placed.groupBy("_group", "_part").agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    carried = stored(parts.select("_group", "_part", (before - F.col("_first") + 1).alias("_shift")), "carried")
    return placed.join(carried, ["_group", "_part"]).select(
        *rows.columns, (F.col("_place") + F.col("_shift")).alias(name)
    )


def _again(aggregate: Column):
    """The function that merges partial results of a min or max."""
    text = str(aggregate)
    for function in (F.min, F.max):
        if text.startswith(f"Column<'{function.__name__}("):
            return function
    raise ValueError(f"only min and max merge over a group, not {aggregate}")
