"""Vector search against brute force: both ways of pruning, ties, odd vectors, one vector in most rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywright.llm import vector_search
from tallywright.llm.vector_search import top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def ints(vector):
    return [math.floor(256 * x) for x in vector]


def brute(rows, every, k):
    sound = [(i, r[0], ints(r[1])) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    found = []
    for i, query_id, q in sound:
        if query_id is None or query_id % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), vec_id is None, vec_id or 0, vec_id) for j, vec_id, v in sound if j != i]
        found += [(query_id, n, vec_id, -score) for n, (score, _, _, vec_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found, key=repr)


def check(spark, rows, every=5, k=5, parts=3):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(vectors, F.col("vec_id") % every == 0, k).collect()]
    assert sorted(got, key=repr) == brute(rows, every, k)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 20)
    monkeypatch.setattr(vector_search, "QUERIES", 7)
    monkeypatch.setattr(vector_search, "CLASSES", 4)


def test_lengths_of_all_sizes_and_close_neighbours(spark, small_blocks):
    """Clusters have high cosines (coordinates), lengths from tiny to large let queries skip classes."""
    rng = random.Random(1)
    rows = []
    for i in range(240):
        base = random.Random(i % 12)
        size = math.exp(rng.uniform(-3, 3))
        rows.append((i, [size * (base.gauss(0, 1) + rng.gauss(0, 0.02)) for _ in range(8)], None))
    rows = [(r[0], [float(F_) for F_ in map(_single, r[1])], r[2]) for r in rows]
    check(spark, rows)


def _single(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_odd_vectors(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (10, [0.0, 0.0], 1), (15, [], 1), (20, None, 1), (25, [1.0, None], 1),
        (30, [nan, 1.0], 1), (35, [inf, 1.0], 1), (None, [1.0, 2.0], 1), (40, [-0.001, 0.0], 1), (45, [1.0, 2.0, 3.0], 1),
        (7, [1.0, 2.0], None), (7, [1.0, 2.0], None), (50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (-5, [-4.0, 2.0], 1),
    ]
    check(spark, rows, k=3)
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0
    assert top_k(spark.createDataFrame(rows[:1], SCHEMA), F.col("vec_id") % 5 == 0).count() == 0


def test_products_beyond_floating_point(spark):
    rows = [(0, [2.0**21, 1.0], 1), (1, [2.0**21, 1.0], 1), (2, [2.0**21, 1.0 + 1 / 256], 1), (3, [2.0**21, 1.0 - 1 / 256], 1)]
    check(spark, rows)


def test_one_vector_in_most_rows(spark, small_blocks):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5, -0.25], 1) for i in range(150)] + [(150 + i, [_single(rng.uniform(-2, 2)) for _ in range(3)], 1) for i in range(60)]
    check(spark, rows, every=10)


def test_blocks_and_their_queries_span_batches(spark, small_blocks):
    """A block's vectors come in several batches, and so do its queries; some queries have more components than the block."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6 if i % 10 else 9)], None) for i in range(150)]
    rows = [(i, list(map(_single, v)), label) for i, v, label in rows] + [(7, [1.0] * 6, None)] * 60
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, rows, every=2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
