"""The mix: targets, closeness to them, reruns, bounds, odd rows; and the whole pipeline."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import odd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallywright.llm import mixing
from tallywright.llm.common import documents
from tallywright.llm.mixing import mix, mixed_documents, targets


def poured(sizes):
    """Targets by resharing, the plain way: [(source_size, weight)] in the order of the sources."""
    amount = 1.5 * sum(s for s, _ in sizes)
    full = set()
    while True:
        left = amount - sum(2 * sizes[i][0] for i in full)
        weights = sum(w for i, (_, w) in enumerate(sizes) if i not in full)
        got = {i: left * w / weights for i, (_, w) in enumerate(sizes) if i not in full} if weights else {}
        over = {i for i, t in got.items() if t > 2 * sizes[i][0]}
        if not over:
            return [2.0 * s if i in full else got[i] for i, (s, _) in enumerate(sizes)]
        full |= over


@pytest.mark.parametrize("seed", range(3))
def test_targets_like_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 1000, rng.randrange(10**6)]) for _ in range(rng.choice([1, 5, 40]))]
    names = [f"s{i:03}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").repartition(3)
    got = sorted(targets(table).collect(), key=lambda r: (r.source is None, r.source))
    expected = poured([(s, (5, 2, 1)[i % 3]) for i, s in enumerate(sizes)])
    assert [r.target for r in got] == pytest.approx(expected, rel=1e-9)


@pytest.mark.parametrize("part", [20_000, 7])
def test_sources_come_near_their_targets(spark, part, monkeypatch):
    monkeypatch.setattr(mixing, "PART", max(part, 7) if part > 100 else 500)
    rows = mix(documents(spark, SMALL)).collect()
    by_source = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by_source[r.source].append(r)
    total = sum(r.size for r in rows)
    for members in by_source.values():
        assert members[0].source_size == sum(r.size for r in members)
        assert abs(sum(r.taken for r in members) - members[0].target) <= 0.0005 * total
    again = mix(documents(spark, SMALL).repartition(7)).collect()
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.doc_id, r.taken) for r in again)


@pytest.mark.parametrize("block, fine", [(7, 10_000), (1024, 100)])
def test_blocks_of_many_words(spark, monkeypatch, block, fine):
    """Coarse blocks change how finely the sources alternate, not the bounds."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "FINE", fine)
    rows = mix(documents(spark, SMALL)).collect()
    total, sums = sum(r.size for r in rows), defaultdict(int)
    for r in rows:
        sums[r.source] += r.taken
        assert r.taken <= 2 * r.size
    assert all(abs(sums[r.source] - r.target) <= 0.03 * total for r in rows)


def sources_in_order(rows):
    """Shares of each source among the words in every tenth of the schedule."""
    words = [(r.source, r.words) for r in sorted(rows, key=lambda r: r.position)]
    total, tenths, at = sum(n for _, n in words), [defaultdict(int) for _ in range(10)], 0
    for source, n in words:
        tenths[min(9, 10 * at // total)][source] += n
        at += n
    return [{s: n / sum(t.values()) for s, n in t.items()} for t in tenths]


def test_sources_alternate_along_the_schedule(spark):
    table = [(i, f"s{i % 3}", " ".join(["word"] * 20)) for i in range(6000)]
    shares = sources_in_order(mixing.uses(spark.createDataFrame(table, "doc_id long, source string, text string")).collect())
    whole = {s: sum(t.get(s, 0) for t in shares) / 10 for s in ("s0", "s1", "s2")}
    assert whole["s0"] > whole["s1"] > whole["s2"]
    assert all(abs(t.get(s, 0) - whole[s]) < 0.03 for t in shares for s in whole)


def test_schedule_ranks_each_source_and_keeps_to_its_blocks(spark):
    table = spark.createDataFrame([(0, 1000, 1500.0, 7), (1, 10, 20.0, 1), (2, 0, 0.0, 1), (3, 500, 100.0, 50)], "nth long, source_size long, target double, words long")
    rows = mixing.schedule(table).collect()
    by_source = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.slot):
        by_source[r.nth].append((r.use, r.block))
    assert set(by_source) == {0, 1, 3} and len({r.slot for r in rows}) == len(rows)
    for nth, blocks in ((0, 143), (1, 10), (3, 10)):
        assert by_source[nth] == [(i // blocks, i % blocks) for i in range(len(by_source[nth]))]
    assert abs(len(by_source[0]) - 215) <= 2 and abs(len(by_source[1]) - 20) <= 1 and abs(len(by_source[3]) - 2) <= 1


def test_a_part_of_a_document_keeps_its_lines(spark):
    df = spark.createDataFrame([(" a  b\n\tc d\n", n) for n in range(1, 5)], "text string, n int")
    got = [r[0] for r in df.orderBy("n").select(mixing._first_words(F.col("text"), F.col("n"))).collect()]
    assert got == ["a", "a  b", "a  b\n\tc", "a  b\n\tc d"]


@pytest.mark.parametrize("block", [1 << 20, 3])
def test_each_source_comes_near_its_own_target(spark, block, monkeypatch):
    """Tiny sources beside a huge one, with blocks as large as the targets allow and with small ones."""
    monkeypatch.setattr(mixing, "BLOCK", block)
    table = [(i, "huge", "word " * 1000) for i in range(300)]
    table += [(1000 + i, f"tiny{i % 4}", "word " * 9) for i in range(40)]
    rows = mix(spark.createDataFrame(table, "doc_id long, source string, text string")).collect()
    sums, target = defaultdict(int), {r.source: r.target for r in rows}
    for r in rows:
        sums[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert set(sums) == {"huge", "tiny0", "tiny1", "tiny2", "tiny3"}
    assert all(abs(sums[s] - target[s]) <= 0.01 * target[s] + 2 for s in sums)


def test_one_source_in_most_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("word "), (F.col("id") % 30).cast("int")).alias("text"),
    )
    rows = mix(docs).collect()
    assert len(rows) == 3000
    hot = [r for r in rows if r.source == "hot"]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 30


def test_odd_rows(spark):
    for docs in (odd.frame(spark), odd.clashing(spark)):
        rows = mix(docs).collect()
        assert len(rows) == len(odd.rows())
        assert {r.taken for r in rows if r.size == 0} == {0}
        mixed = mixed_documents(docs)
        assert mixed.columns == docs.columns
        uses = Counter(r.doc_id for r in mixed.collect())
        assert uses and max(uses.values()) <= 4 and None in uses  # rows that repeat a document: their uses together
    assert mix(odd.empty(spark)).count() == 0 and mixed_documents(odd.empty(spark)).count() == 0
    assert mix(spark.createDataFrame([(1, "", "a")], "doc_id long, text string, source string")).first().taken == 0


def test_mixed_documents_hold_the_words_taken(spark):
    docs = documents(spark, SMALL)
    taken = {r.doc_id: r.taken for r in mix(docs).collect()}
    got = defaultdict(int)
    for r in mixed_documents(docs).collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert got == {k: v for k, v in taken.items() if v}


def test_pipeline(spark):
    docs = documents(spark, SMALL)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        kept[name] = [r.doc_id for r in out.select("doc_id").collect()]
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    names = list(kept)
    assert all(set(kept[b]) <= set(kept[a]) for a, b in zip(names, names[1:]))
    assert len(kept["near_dedup"]) == len(set(kept["near_dedup"]))
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert set(r.doc_id for r in packed) == set(kept["mixing"])
    assert sum(r.start == 0 for r in packed) == len(kept["mixing"])


def test_pipeline_on_odd_rows(spark):
    docs = odd.clashing(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() > 0
    docs = odd.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
