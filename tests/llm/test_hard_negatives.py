"""Hard negatives against brute force, the Hilbert curve and the intervals by their properties."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import hard_negatives as module
from tallywright.llm.hard_negatives import ZoneSearch, bounds, hard_negatives, hilbert_place, write_blocks

SCHEMA = "vec_id long, embedding array<float>, label int"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def brute(rows, every, positives=5, negatives=10, least_percent=30, most_percent=90):
    sound = [
        (i, r[0], [math.floor(256 * x) for x in r[1]], r[2]) for i, r in enumerate(rows)
        if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    found = []
    for i, anchor, q, label in sound:
        if anchor is None or anchor % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), vec_id is None, vec_id or 0, j, vec_id, own) for j, vec_id, v, own in sound if j != i)
        liked = [s for s in scored if s[5] == label][:positives]
        for minus, _, _, _, positive, _ in liked:
            fit = [s for s in scored if s[5] != label and -least_percent * minus <= -100 * s[0] <= -most_percent * minus][:negatives]
            found += [(anchor, positive, n, s[4], -minus, -s[0]) for n, s in enumerate(fit, 1)]
    return sorted(found, key=repr)


def check(spark, rows, every=5, parts=3, **settings):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = hard_negatives(vectors, F.col("vec_id") % every == 0, F.col("label"), **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, every, **settings)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK", 16), ("ZONES", 4), ("CHUNK", 8)):
        monkeypatch.setattr(module, name, value)


def test_clusters_over_many_blocks(spark, small_blocks):
    rng = random.Random(1)
    rows = []
    for i in range(250):
        centre = random.Random(i % 9)
        rows.append((i, [single(centre.gauss(0, 1) + rng.gauss(0, 0.3)) for _ in range(6)], (i // 3) % 4))
    check(spark, rows)
    check(spark, rows, positives=2, negatives=3, least_percent=0, most_percent=100)


def test_odd_vectors(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (5, [1.0, 2.0], 2), (10, [0.0, 0.0], 1), (15, [], 1), (20, None, 1), (25, [1.0, None], 1),
        (30, [nan, 1.0], 1), (35, [inf, 1.0], 1), (None, [1.0, 2.0], 1), (None, [0.5, 1.0], 2), (40, [-0.001, 0.0], 1),
        (45, [1.0, 2.0, 3.0], 1), (7, [0.5, 0.5], None), (50, [0.5, 1.0], 2), (50, [0.5, 1.0], 2), (-5, [-4.0, 2.0], 1),
        (2**62, [0.5, 0.75], 3), (55, [0.5, 0.75], -3),
    ]
    check(spark, rows)
    for few in ([], rows[:1], rows[3:4]):
        assert hard_negatives(spark.createDataFrame(few, SCHEMA), F.col("vec_id") % 5 == 0, F.col("label")).collect() == []
    clashing = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("kept") for c in ("row", "id", "asks", "block", "ints", "rank")})
    got = hard_negatives(clashing, F.col("vec_id") % 5 == 0, F.col("label")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 5)


def test_one_label_and_one_vector_in_most_rows(spark, small_blocks):
    rng = random.Random(2)
    rows = [(i, [1.0, 0.5, -0.25], 1) for i in range(120)]
    rows += [(120 + i, [single(rng.uniform(-1, 1)) for _ in range(3)], rng.choice([1, 1, 2, 3])) for i in range(80)]
    check(spark, rows, every=10)


def test_products_beyond_floating_point(spark):
    big = 2.0**21
    rows = [(i, [big, single(1 + i / 256)], i % 2) for i in range(6)]
    check(spark, rows, most_percent=100)


@pytest.mark.parametrize("axes, bits", [(2, 4), (3, 3)])
def test_the_curve_visits_every_cell_by_single_steps(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    place = hilbert_place(grid, bits)
    assert sorted(place) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_intervals_hold_all_products():
    rng = np.random.default_rng(0)
    anchors, block = rng.integers(-300, 300, (20, 5)), rng.integers(-300, 300, (50, 5))
    low, high = bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    products = anchors @ block.T
    assert (low[:, 0] <= products.min(axis=1)).all() and (products.max(axis=1) <= high[:, 0]).all()


def test_far_blocks_are_not_read(spark, small_blocks):
    """Clusters apart along one axis: a window of high scores needs few of the blocks."""
    rows = [(i, i, False, 1, [int(100 * (i // 40)), i % 7]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "row long, vec_id long, no_id boolean, label long, ints array<long>")
    search = ZoneSearch(write_blocks(vectors), vectors.where("row = 399"))
    asked = search.anchors.withColumns({"tops": F.array(F.lit(2**62)), "floors": F.array(F.lit(850 * 900))})
    assert search.blocks.count() == 25
    assert search._with_zones(asked, module._choose(True), "row long, block long").count() <= 8
