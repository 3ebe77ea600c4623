"""Connected components of a graph of links, on Spark alone.

Large-star and small-star steps alternate until nothing changes: each node's larger neighbours, then its smaller
ones, are linked to the smallest node in sight. The number of links never grows and a node with very many links
is joined by broadcast of its one row (``common.by_weight``), so no task gathers its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import by_weight, stored


def _star(pairs: DataFrame, total: int) -> DataFrame:
    """(u, v, least): each pair with the smallest of u and its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"), F.count("*").alias("n"))
    return by_weight(pairs, stored(least, "stars"), "u", "n", total)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node that occurs in ``links`` (a, b); the component is its smallest node."""
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = stored(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "links-both")
        large = _star(both, both.count()).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = stored(large.distinct(), "links-large")
        small = _star(large, large.count())
        moved = small.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        links = stored(moved.unionByName(small.select("u", F.col("least").alias("v"))).distinct(), "links")
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
