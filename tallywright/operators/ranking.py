"""Row positions, ranks and n-tiles that no single task has to hold.

``row_number`` and ``ntile`` over a large group put the whole group in one
partition. Positions and ranks come from a range partitioning and the sizes of the
earlier partitions, one small row each; n-tiles from the few rows where one tile
ends; the best k of a group from the best k of its parts. What is stored on the way is
a sort key and the key to join back by, unless a caller has no such key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.operators.scan import Term, prefix_sums, row_numbers, sort_terms
from tallywright.session import stored

_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id


def with_position(df: DataFrame, order_by: Sequence[Column], name: str = "position") -> DataFrame:
    """Adds the 1-based position in the total order. The sort key must be unique."""
    place = F.monotonically_increasing_id()
    placed = stored(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.shiftright(place, _ROWS_PER_PARTITION_BITS))
        .withColumn("_nth", place.bitwiseAND(F.lit((1 << _ROWS_PER_PARTITION_BITS) - 1))),
        "positions",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the sort: bounded by the shuffle partitions
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_nth") + 1)
        .drop("_part", "_nth", "_before")
    )


def rank_within(
    df: DataFrame, groups: Sequence[str], order_by: Sequence[Column], name: str, key: Sequence[str] = ()
) -> DataFrame:
    """``row_number`` over ``groups``, safe for a group that holds most rows.

    With ``key``, the unique key of the rows, only groups, sort keys and key are
    ranked and stored, and the rank is joined back: pass a stored frame, it is read for
    both. Else whole rows are ranked and stored.
    """
    if not key:
        return row_numbers(df, groups, order_by, name)
    needed = dict.fromkeys([*groups, *(term.name for term in sort_terms(order_by)), *key])
    ranked = row_numbers(df.select(*needed), groups, order_by, name)
    ranks = ranked.select(name, *(F.col(k).alias(f"_{k}") for k in key))
    same_row = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return df.join(ranks, same_row).drop(*(f"_{k}" for k in key))


def with_ntile(df: DataFrame, buckets: int, order_by: Sequence[Column], name: str) -> DataFrame:
    """Exact ``ntile(buckets)``: the first N % buckets tiles get one row more.

    The rows are never sorted as a whole. Counts per value of the first sort key, summed up in
    order, tell in which value each tile ends; only rows of such values are numbered, by the
    other keys. That gives the last row of each tile, at most ``buckets - 1``
    of them, and a row's tile is the number of those it comes after, plus one.
    """
    value, *ties = terms = sort_terms(order_by)
    names = [term.name for term in terms]
    keys = stored(df.select(*names), "tile-keys")
    if set(df.columns) == set(names):
        df = keys.select(df.columns)
    counted = prefix_sums(
        keys.groupBy(value.name).agg(F.count("*").alias("_rows")), [], [value.column()], {"_through": F.col("_rows")}
    )
    counted = stored(counted, "tile-values")
    n = counted.agg(F.max("_through")).first()[0] or 0
    ends = {t * (n // buckets) + min(t, n % buckets) for t in range(1, buckets)} - {0, n}
    ends_here = F.filter(
        F.array(*map(F.lit, sorted(ends))).cast("array<bigint>"),
        lambda end: (end > F.col("_through") - F.col("_rows")) & (end <= F.col("_through")),
    )
    # at most one row per tile
    within = counted.withColumn("_ends", ends_here).where(F.size("_ends") > 0).orderBy("_through").collect()
    cuts = [row for found in within for row in _last_rows(keys, value, ties, found)]
    tile = reduce(Column.__add__, [_comes_after(keys, terms, cut).cast("bigint") for cut in cuts], F.lit(1).cast("bigint"))
    return df.withColumn(name, tile)


def _last_rows(keys: DataFrame, value: Term, ties: list[Term], found) -> list[tuple]:
    """Sort keys of the tiles' last rows inside one value; only the value where a tile ends with it."""
    places = [end - (found["_through"] - found["_rows"]) for end in found["_ends"]]
    inner = [place for place in places if place < found["_rows"]]
    rows: list[tuple] = []
    if inner:
        same = keys.where(F.col(value.name).eqNullSafe(_literal(keys, value, found[value.name])))
        numbered = prefix_sums(same, [], [tie.column() for tie in ties], {"_place": F.lit(1)})
        last = numbered.where(F.col("_place").isin(inner)).orderBy("_place").collect()
        rows = [(found[value.name], *(row[tie.name] for tie in ties)) for row in last]
    return rows + [(found[value.name],)] * (len(places) - len(inner))


def _literal(df: DataFrame, term: Term, value) -> Column:
    return F.lit(value).cast(df.schema[term.name].dataType)


def _comes_after(df: DataFrame, terms: list[Term], cut: tuple) -> Column:
    """Whether a row sorts after the given sort keys (a leading part of them stands for its last row)."""
    after, equal = F.lit(False), F.lit(True)
    for term, value in zip(terms, cut):
        value = _literal(df, term, value)
        after = after | (equal & term.comes_after(value))
        equal = equal & F.col(term.name).eqNullSafe(value)
    return after


def top_within(df: DataFrame, groups: Sequence[str], order_by: Sequence[Column], k: int, name: str) -> DataFrame:
    """The first k rows of each group with their rank. The sort key must be unique.

    In two steps, alike for every k: the best k of each (group, part), cut off before and
    after the shuffle, then ranks over those that are left. A part is a hash of the sort
    keys, so a group that holds most rows is spread over all of them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [term.column() for term in sort_terms(order_by)]
    salt = F.pmod(F.xxhash64(*(term.name for term in sort_terms(order_by))), F.lit(parts))
    salted = df.withColumn("_salt", salt)
    best = salted.withColumn(name, F.row_number().over(Window.partitionBy(*groups, "_salt").orderBy(*order)))
    left = best.where(F.col(name) <= k).drop(name, "_salt")
    ranked = left.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("bigint"))
    return ranked.where(F.col(name) <= k)
