"""Helpers the operators share: text keys, stored frames, joins on keys that repeat a lot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywright.session import shared_folder, small_batches, stored

__all__ = ["FEW", "by_weight", "documents", "free", "in_order", "same", "shared_folder", "small_batches", "stored", "sums_before", "words_in"]

#: a key counts as heavy if it holds at least one row in this many; so there are at most this many heavy keys
FEW = 1000

#: white space of the text contracts: space, and tab to carriage return
BLANKS = " \t\n\u000b\u000c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def free(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of the frame has, in any case."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (f"{'_' * i}{name}" for i in range(1, len(taken) + 2)) if n not in taken) for name in names]


def words_in(text: Column) -> Column:
    """Number of words: runs of other than white space. A missing text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def by_weight(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``table`` on ``key``, whatever share of the rows one key holds.

    ``table`` has one row for each key, and in ``weight`` how many of the ``total`` rows have it. The at
    most ``FEW`` keys with one row in ``FEW`` or more are joined by broadcast, where rows stay as they are;
    the others, none of them large, by a shuffle. Both inputs are read twice: pass stored frames.
    """
    heavy = F.col(weight) * FEW >= F.lit(total)
    few = table.where(heavy)
    light = rows.join(F.broadcast(few.select(key)), key, "left_anti")
    return rows.join(F.broadcast(few), key).unionByName(light.join(table.where(~heavy), key, how))


def sums_before(rows: DataFrame, keys: list[str], part: Column, order: list[str], **sums: Column) -> DataFrame:
    """Adds columns with the sum of an expression over all earlier rows of the same keys.

    A key may hold most rows: each is summed in parts, which follow one another in the order, with an offset for
    each part from a frame of one row for each key and part. Choose parts of bounded size.
    """
    rows = rows.withColumn("_part", part)
    offsets = rows.groupBy(*keys, "_part").agg(*(F.sum(v).alias(f"_offset_{k}") for k, v in sums.items()))
    parts = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select(*keys, "_part", *(F.coalesce(F.sum(f"_offset_{k}").over(parts), F.lit(0)).alias(f"_offset_{k}") for k in sums))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()})
    joined = running.join(offsets, [*keys, "_part"])
    return joined.withColumns({k: F.col(k) + F.col(f"_offset_{k}") for k in sums}).drop("_part", *(f"_offset_{k}" for k in sums))


def in_order(rows: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """Adds columns with the sum of an expression over all rows that sort earlier, with no key at all.

    The rows are ranged and stored; the offsets have one row for each partition of the range.
    """
    placed = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}),
        "in-order",
    )
    offsets = placed.groupBy("_part").agg(*(F.sum(v).alias(f"_offset_{k}") for k, v in sums.items()))
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = offsets.select("_part", *(F.coalesce(F.sum(f"_offset_{k}").over(parts), F.lit(0)).alias(f"_offset_{k}") for k in sums))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in sums.items()})
    joined = running.join(F.broadcast(offsets), "_part")
    return joined.withColumns({k: F.col(k) + F.col(f"_offset_{k}") for k in sums}).drop("_part", "_place", *(f"_offset_{k}" for k in sums))
