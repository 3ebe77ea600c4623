"""Exact top-k inner products: vectors bucketed by length, pruned by local cosine thresholds, products verified.

Vectors are put in classes of similar length (quantiles, ``CLASSES`` of them) and a class in blocks of about
``BLOCK`` rows; queries in blocks of about ``QUERIES``. One block of the longest vectors gives every query k scores
to begin with. Its k-th score, divided by the lengths of the query and of a class, is the cosine that any better
vector of that class must reach: beyond 1 the query skips the class. In a block, a query with a high threshold
tests its largest coordinates against the range that the threshold leaves them, and one with a low threshold takes
the prefix of long enough vectors. Products are exact integers; the k best of each block meet once more by query.

Work is split by blocks only, so that one vector may be repeated in most rows. A block is shuffled once; the queries
that may find something there follow it, sorted behind its vectors, and are answered ``QUERIES`` at a time. Defined results: a vector that is
null or holds a null or non-finite component takes no part. A shorter vector counts as padded with zeros. Rows that
repeat an id are candidates each, and the own row alone is left out. Scores beyond 64 bits are cut to the limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import stored

CLASSES, BLOCK, QUERIES = 32, 4096, 1024
#: from this local cosine on coordinates are tested, and so many of them
COORDINATE_FROM, FOCUS = 0.8, 4
_SLACK = 1e-9  # of the pruning bounds, which are not integers


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, ints (floor of the scaled components) and length of the vectors that take part."""
    values = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    ints = vectors.where(F.col(vector).isNotNull() & sound).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(values, lambda x: F.floor(x * scale)).alias("ints")
    )
    squares = F.aggregate("ints", F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    return ints.withColumn("length", F.sqrt(squares))


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    made = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        made[i, : len(row)] = row
    return made


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point is used only while it is exact."""
    most = [float(np.abs(m.astype(float)).max(initial=0)) for m in (queries, vectors)]
    if most[0] * most[1] * max(1, queries.shape[1]) < 2**53:
        return (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


class _Block:
    """Vectors of one block, the longest first, with their unit vectors sorted by a coordinate when asked."""

    def __init__(self, rows: pd.DataFrame, width: int):
        rows = rows.sort_values("length", ascending=False, kind="stable")
        self.row, self.vec_id = rows["row"].to_numpy(), rows["vec_id"].to_numpy()
        self.length, self.ints = rows["length"].to_numpy(), _matrix(rows["ints"], width)
        self.unit = self.ints / np.where(self.length > 0, self.length, 1)[:, None]
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def widen(self, width: int) -> None:
        """Pads the vectors with zeros."""
        if (more := width - self.ints.shape[1]) > 0:
            self.ints, self.unit = (np.pad(m, ((0, 0), (0, more))) for m in (self.ints, self.unit))

    def within(self, query: np.ndarray, cosine: float) -> np.ndarray:
        """Places of the vectors whose largest coordinates allow this cosine with a unit query."""
        found = None
        for f in np.argsort(-np.abs(query))[:FOCUS]:
            reach = np.sqrt(max(0.0, (1 - cosine**2) * (1 - query[f] ** 2)))
            low = -1.0 if query[f] <= -cosine else query[f] * cosine - reach
            high = 1.0 if query[f] >= cosine else query[f] * cosine + reach
            low, high = low - _SLACK, high + _SLACK
            if found is None:
                if f not in self._sorted:
                    order = np.argsort(self.unit[:, f], kind="stable")
                    self._sorted[f] = order, self.unit[order, f]
                order, values = self._sorted[f]
                found = order[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            else:
                found = found[(self.unit[found, f] >= low) & (self.unit[found, f] <= high)]
        return found

    def best(self, row: int, scores: np.ndarray, at: np.ndarray, k: int, least: float):
        """The k best (score, then smaller id) of the given places, without the query's own row."""
        keep = (self.row[at] != row) & (scores >= least)
        scores, at = scores[keep], at[keep]
        if len(scores) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, at = scores[keep], at[keep]
        order = np.lexsort((self.vec_id[at], -scores))[:k]
        return scores[order], self.vec_id[at[order]]


_FOUND = ["row", "query_id", "vec_id", "score"]
_FOUND_TYPES = "row long, query_id long, vec_id long, score long"


def _searcher(k: int) -> Callable[[_Block, pd.DataFrame], pd.DataFrame]:
    def search(block: _Block, queries: pd.DataFrame) -> pd.DataFrame:
        block.widen(max(map(len, queries["ints"])))
        asked = _matrix(queries["ints"], block.ints.shape[1])
        least, lengths = queries["least"].fillna(-np.inf).to_numpy(), queries["length"].to_numpy()
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where((lengths > 0) & (least > 0), least / (lengths * block.length[0]), -np.inf)
        cosine = cosine - _SLACK
        found = []

        def keep(i: int, scores: np.ndarray, at: np.ndarray) -> None:
            scores, ids = block.best(queries["row"].iat[i], scores, at, k, least[i])
            found.append(pd.DataFrame({
                "row": queries["row"].iat[i], "query_id": queries["query_id"].iat[i], "vec_id": ids, "score": scores,
            }))

        # by length: the prefix of vectors long enough, for all such queries at once
        by_length = np.flatnonzero(cosine < COORDINATE_FROM)
        if len(by_length):
            needed = np.where(least > 0, least / np.where(lengths > 0, lengths, np.inf), 0)[by_length] * (1 - _SLACK)
            n = int(np.searchsorted(-block.length, -needed.min(), "right"))
            scores = _products(asked[by_length], block.ints[:n])
            for i, row in zip(by_length, scores):
                keep(i, row, np.arange(n))
        for i in np.flatnonzero((cosine >= COORDINATE_FROM) & (cosine <= 1)):
            at = block.within(asked[i] / lengths[i], cosine[i])
            keep(i, _products(asked[i : i + 1], block.ints[at])[0], at)
        return pd.concat(found)[_FOUND] if found else pd.DataFrame([], columns=_FOUND).astype("int64")

    return search


def _answered(k: int):
    """Goes through rows sorted by block, the vectors of a block before its queries; holds one block and one batch."""
    search = _searcher(k)

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, vectors, block = None, [], None
        for batch in batches:
            for key, rows in batch.groupby(["part", "class", "block"], sort=False):
                if key != at:
                    at, vectors, block = key, [], None
                if not rows["asking"].all():
                    vectors.append(rows[~rows["asking"]])
                queries = rows[rows["asking"]].rename(columns={"vec_id": "query_id"})
                if not len(queries) or not vectors:
                    continue
                if block is None:
                    together = pd.concat(vectors)
                    block = _Block(together, max(map(len, together["ints"])))
                for start in range(0, len(queries), QUERIES):
                    yield search(block, queries.iloc[start : start + QUERIES])

    return answer


def _meet(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of each (part, class, block) for each query that is sent there."""
    keys = ["part", "class", "block"]
    both = vectors.withColumns({"asking": F.lit(False), "least": F.lit(None).cast("double")}).select(
        *keys, "asking", "row", "vec_id", "ints", "length", "least"
    )
    both = both.unionByName(queries.withColumn("asking", F.lit(True)).select(both.columns))
    return both.repartition(*keys).sortWithinPartitions(*keys, "asking").mapInPandas(_answered(k), _FOUND_TYPES)


def top_k(vectors: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best vectors for each row for which ``asks`` holds."""
    rows = stored(
        integer_vectors(vectors).withColumns({"asks": F.coalesce(asks, F.lit(False)), "row": F.monotonically_increasing_id()}),
        "vectors",
    )
    steps = [i / CLASSES for i in range(1, CLASSES)]
    bounds, asked = rows.agg(F.percentile_approx("length", steps, 10_000), F.count_if("asks")).first()
    bounds = sorted(set(bounds or []))
    above = F.filter(F.array(*map(F.lit, bounds)).cast("array<double>"), lambda b: F.col("length") >= b)
    rows = rows.withColumn("class", F.size(above))
    classes = rows.groupBy("class").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()  # <= CLASSES
    blocks = {r["class"]: -(-r["n"] // BLOCK) for r in classes}
    n_blocks = F.create_map(*(F.lit(x) for item in (blocks or {0: 1}).items() for x in item))[F.col("class")]
    spread, whole = F.xxhash64("row"), F.lit(0).alias("part")
    columns = ["row", "vec_id", "ints", "length"]
    candidates = rows.select(whole, "class", F.pmod(spread, n_blocks).cast("int").alias("block"), *columns)
    queries = rows.where("asks").select(*columns).toDF(*columns)
    # one block of the longest class is enough to begin with: a copy of it for so many queries
    parts = max(1, -(-asked // (QUERIES * 4)))
    longest = max(blocks, default=0)
    first = candidates.where((F.col("class") == longest) & (F.col("block") == 0)).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    begin = queries.select(
        F.pmod(spread, F.lit(parts)).cast("int").alias("part"), F.lit(longest).alias("class"), F.lit(0).alias("block"), *columns,
        F.lit(None).cast("double").alias("least"),
    )
    begun = _meet(first, begin, k)
    floors = begun.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least"))
    # a query goes to the blocks of the classes that can hold a better vector
    table = F.array(*(
        F.struct(F.lit(r["class"]).alias("class"), F.lit(blocks[r["class"]]).alias("blocks"), F.lit(r["longest"]).alias("longest"))
        for r in classes
    )) if classes else F.array().cast("array<struct<class: int, blocks: int, longest: double>>")
    reachable = F.filter(
        table, lambda t: F.col("least").isNull() | (F.col("least") <= F.col("length") * t["longest"] * (1 + _SLACK))
    )
    sent = queries.join(floors, "row", "left").withColumn("_to", F.explode(reachable))
    sent = sent.select(
        whole, F.col("_to.class").alias("class"), F.explode(F.sequence(F.lit(0), F.col("_to.blocks") - 1)).alias("block"), *columns, "least"
    )
    found = _meet(candidates, sent, k)
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
