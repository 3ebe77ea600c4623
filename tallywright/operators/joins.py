"""Lookups by a key that may be null in most rows, or hold most rows by itself.

Adaptive execution splits a hot key only while no window or aggregate needs the
key's rows together above the join, and only at run time. Here the spreading is part of the
plan: rows without a key are dealt to all tasks, and a key that was measured to be
hot is split by a salt, its one row on the other side being copied to each part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallywright.session import shuffles_freed

#: a key is hot if it holds at least one row in this many; so there are at most this many
HOT_SHARE = 1000
#: keys that the sketch keeps, several times as many as can be hot
_TRACKED = 10 * HOT_SHARE


def hot_keys(rows: DataFrame, *keys: str) -> dict[str, list]:
    """The keys of each column that hold a thousandth of the rows or more.

    One pass over the key columns with a sketch of the most frequent values, merged
    by task: nothing is shuffled by key, and at most ``HOT_SHARE`` keys a column reach
    the driver. The list steers how rows are dealt, never which rows come out, so
    an estimate will do.
    """
    if any(not isinstance(rows.schema[key].dataType, IntegralType) for key in keys):
        raise TypeError("hot keys are measured on whole numbers")
    sketches = [F.expr(f"approx_top_k({key}, {HOT_SHARE}, {_TRACKED})").alias(key) for key in keys]
    with shuffles_freed(rows.sparkSession):
        found = rows.select(*(F.col(key).cast("bigint").alias(key) for key in keys)).agg(F.count("*").alias("_rows"), *sketches).first()
    least = max(2, found["_rows"] / HOT_SHARE)
    return {key: sorted(x["item"] for x in found[key] if x["item"] is not None and x["count"] >= least) for key in keys}


def lookup(
    rows: DataFrame, table: DataFrame, key: str, spread_by: str, hot: Sequence = (), parts: int | None = None,
    part: str | None = None,
) -> DataFrame:
    """``rows`` left-joined to ``table``, which has one row for each key.

    Rows whose key is null match nothing, and are dealt to ``parts`` tasks (as many as there
    are shuffle partitions) by ``spread_by``, a column with many values; so are the rows of
    the ``hot`` keys. ``part`` names the column where ``dealt`` has already put the task.
    """
    parts = parts or _tasks(rows)
    if not part:
        part, rows = "_part", dealt(rows, key, spread_by, hot, parts)
    known = table.withColumn(part, F.explode(_copies(F.col(key), hot, parts)) if hot else F.lit(0))
    return rows.join(known, [key, part], "left").drop(part)


def dealt(
    rows: DataFrame, key: str, spread_by: str, hot: Sequence = (), parts: int | None = None, part: str = "_part"
) -> DataFrame:
    """Adds the task that ``lookup`` deals a row to, 0 for those that go by their key alone.

    Before a chain of lookups, so that ``spread_by`` need not travel through all of their shuffles.
    """
    parts = parts or _tasks(rows)
    spread = F.col(key).isNull()
    if hot:
        spread = spread | F.col(key).isin(*hot)
    # by the row's own content: the same row goes the same way when a task is run again
    return rows.withColumn(part, F.when(spread, F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("int")).otherwise(0))


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _copies(key: Column, hot: Sequence, parts: int) -> Column:
    return F.when(key.isin(*hot), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))


HotKeys = Mapping[str, Sequence]
