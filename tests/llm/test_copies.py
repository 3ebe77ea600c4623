"""Exact dedup, line dedup and near-dedup against plain Python, on odd rows and large groups."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import odd
import pytest
from pyspark.sql import functions as F

from tallywright import session
from tallywright.llm.common import shared_folder
from tallywright.llm.exact_dedup import DigestIndex, without_copies
from tallywright.llm.line_dedup import drop_shared_lines
from tallywright.llm.near_dedup import matches, near_duplicates, without_near_duplicates


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_on_odd_rows(spark):
    for docs in (odd.frame(spark), odd.clashing(spark)):
        got = DigestIndex.temporary(spark).admit(docs).collect()
        assert len(got) == len(odd.rows())
        groups = defaultdict(list)
        for i, (doc_id, text, *_) in enumerate(odd.rows()):
            groups[norm(text)].append((-len(text or ""), doc_id is None, doc_id or 0, i))
        expected = Counter()
        for text, members in groups.items():
            keep = odd.rows()[min(members)[3]][0]
            digest = hashlib.sha256(text.encode()).hexdigest()
            for member in members:
                expected[odd.rows()[member[3]][0], keep, len(members), digest] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        stay = without_copies(docs)
        assert stay.columns == docs.columns and stay.count() == len(groups)


def test_index_remembers_earlier_batches(spark):
    name = "digests_test"
    folder = f"{shared_folder(spark)}/{name}"
    index = DigestIndex(spark, name, folder, 4)
    one = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(3, "a    b"), (4, "d"), (5, "d")], "doc_id long, text string")
    index.admit(one).collect()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.admit(two).collect()}
    assert got == {3: (1, 1, False), 4: (4, 2, True), 5: (4, 2, False)}
    assert index.frame().count() == 3
    reopened = DigestIndex(spark, name, folder, 4)
    # a batch that comes again, as after a lost job, has the same result and adds nothing
    again = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in reopened.admit(two.repartition(3)).collect()}
    assert again == got and index.frame().count() == 3
    # the row that stands for a text stays, whatever longer copy comes with it
    three = spark.createDataFrame([(4, "d"), (4, "d"), (8, " d "), (None, "e"), (None, "e "), (1, "new")], "doc_id long, text string")
    for _ in range(2):
        kept = Counter((r.doc_id, r.keep_id, r.kept) for r in reopened.admit(three).collect())
        assert kept == Counter([(4, 4, True), (4, 4, False), (8, 4, False), (None, None, True), (None, None, False), (1, 1, True)])
    with pytest.raises(ValueError, match="4 buckets"):
        DigestIndex(spark, name, folder, 8)
    spark.sql(f"DROP TABLE `{name}`")


def test_index_is_read_in_its_buckets(spark):
    index = DigestIndex.temporary(spark)
    batch = spark.createDataFrame([(i, str(i)) for i in range(50)], "doc_id long, text string")
    index.admit(batch).collect()
    groups = batch.select(F.unhex(F.sha2("text", 256)).alias("digest")).groupBy("digest").count()
    plan = groups.join(index.frame().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("least", [1, 2, 3])
def test_lines_on_odd_rows(spark, least):
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    texts = [(r[1] or "") for r in odd.rows()] + ["Same\n x\n\nSAME \nrest"] * 3
    table = [(i, t) for i, t in enumerate(texts)]
    counts = Counter(k for t in texts for k in {key(x) for x in t.split("\n")})
    docs = spark.createDataFrame(table, "doc_id long, text string").withColumn("lines", F.lit("kept"))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text, r.lines) for r in drop_shared_lines(docs, least).collect()}
    for i, text in table:
        lines = text.split("\n")
        stay = [x for x in lines if not key(x) or counts[key(x)] < least]
        assert got[i] == (len(lines), len(lines) - len(stay), "\n".join(stay), "kept")


def test_lines_count_documents_not_rows(spark):
    """One document repeated ten times is one; a line of nine others and it is found in ten."""
    rows = [(1, "mine\nshared")] * 10 + [(1, "mine\nother")] + [(i, f"own {i}\nshared") for i in range(2, 11)]
    docs = spark.createDataFrame(rows + [(None, "free\nhere")] * 10, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in drop_shared_lines(docs, 10).collect())
    expected = Counter({(1, 2, 1, "mine"): 10, (1, 2, 0, "mine\nother"): 1, (None, 2, 2, ""): 10})
    expected.update({(i, 2, 1, f"own {i}"): 1 for i in range(2, 11)})
    assert got == expected


def test_lines_keep_rows_without_an_id(spark):
    assert drop_shared_lines(odd.frame(spark), 2).count() == len(odd.rows())
    assert drop_shared_lines(odd.empty(spark)).count() == 0


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts):
    """doc_id to (size of the set, smallest id reachable)."""
    sets = {i: sets_of(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def family(rng, size, n_words, edits):
    """Copies of one text, each with its own number of changed words; the original need not be among them."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.choice(edits)):
            copy[rng.randrange(n_words)] = f"w{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_near_against_brute_force(spark):
    rng = random.Random(5)
    texts = []
    texts += family(rng, 120, 150, [0, 1, 1, 2, 2, 3, 4, 6])  # all degrees of likeness around the threshold
    texts += family(rng, 60, 150, [1, 2, 3])  # no original
    texts += family(rng, 30, 12, [0, 0, 1])
    texts += family(rng, 10, 3, [0, 1])
    chain = [f"c{i}" for i in range(200)]
    for i in range(25):  # each is like the next, the ends are not alike
        texts.append(" ".join(chain[i * 4 :] + [f"d{j}" for j in range(i * 4)]))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 90))) for _ in range(80)]
    texts += ["", " \n", "Same Words", "same\twords", "a b c d", "a b c d e"]
    rng.shuffle(texts)
    table = dict(enumerate(texts))
    docs = spark.createDataFrame(list(table.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(table)


def test_near_on_odd_rows(spark):
    got = near_duplicates(odd.clashing(spark)).collect()
    assert len(got) == len(odd.rows())
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.component_id, r.kept))
    assert by_id[3] == {(3, True)} and by_id[4] == {(4, True)} and by_id[None] == {(None, True)}
    assert by_id[8] == {(8, True)}  # a row that repeats an id and a text has the same result
    assert by_id[6] == {(6, True)} and by_id[7] == {(6, False)}
    stay = without_near_duplicates(odd.clashing(spark))
    assert stay.columns == odd.clashing(spark).columns and stay.where("doc_id = 7").count() == 0
    assert near_duplicates(odd.empty(spark)).count() == 0


def test_python_workers_get_small_batches(spark, monkeypatch):
    """Workers keep the memory of their largest batch: 1000 rows and about 4 MB of texts bound it, in both stages with texts."""
    from tallywright.llm import near_dedup

    described, most_rows, most_bytes = near_dedup._described, 1000, 5 << 20

    def watched(batches):
        def small():
            for batch in batches:
                assert len(batch) <= most_rows and batch["text"].str.len().sum() <= most_bytes
                yield batch

        return described(small())

    @F.pandas_udf("long")
    def together(texts):
        return texts.str.len() * 0 + max(len(texts), texts.str.len().sum() * most_rows // most_bytes)

    monkeypatch.setattr(near_dedup, "_described", watched)
    text = F.repeat(F.lit("x"), F.when(F.col("id") < 2000, 10).otherwise(20_000))
    docs = spark.range(2600, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"))
    for stage in (near_duplicates, lambda rows: corpus_pipeline.language_id(spark, rows, "").select("doc_id", together("text").alias("m"))):
        for key in session.BATCHES:
            spark.conf.unset(key)
        found = stage(docs).collect()
        assert len(found) == 2600 and all(r.m <= most_rows for r in found if "m" in r)


def test_near_in_a_hot_group(spark):
    """A third of all rows are copies of one text, and a third are near copies of another."""
    rng = random.Random(6)
    texts = ["the same words again and again in every row"] * 700 + list(family(rng, 700, 120, [0, 1]))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(30)) for _ in range(700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    found = near_duplicates(docs)
    sizes = Counter(r.component_id for r in found.collect())
    assert sizes[0] == 700 and sum(n == 1 for c, n in sizes.items() if c >= 1400) == 700
    near = [n for c, n in sizes.items() if 700 <= c < 1400]
    assert near == [700]


def test_different_texts_under_one_id_lose_no_link(spark):
    rng = random.Random(8)
    a, b, c = ([f"{k}{rng.randrange(10**6)}" for _ in range(60)] for k in "abc")
    rows = [(1, a), (1, b), (3, [*b, "more"]), (4, [*a, "more"]), (5, c), (6, [*c, "more"]), (6, ["quite", "other"]), (9, ["quite", "other"])]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in rows], "doc_id long, text string")
    for parts in (1, 3):
        got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs.repartition(parts)).collect()}
        assert got == {(1, 1, True), (3, 1, False), (4, 1, False), (5, 5, True), (6, 5, False), (9, 5, False)}


def test_near_in_a_family_without_its_original(spark, monkeypatch):
    """One template, a few words changed in each copy, no copy like the template itself: rounds of new centres merge them."""
    from tallywright.llm import near_dedup

    made = []
    paired = near_dedup._paired
    monkeypatch.setattr(near_dedup, "_paired", lambda pairs, described: made.append(pairs.count()) or paired(pairs, described))
    rng = random.Random(9)
    texts = list(family(rng, 200, 200, [2]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(dict(enumerate(texts)))
    assert sum(made) < 199 * 200 / 2  # meetings of two signatures or sets


@pytest.mark.parametrize("percent, coordinates", [(85, 38), (80, 34)])
def test_near_pairs_between_the_thresholds(spark, percent, coordinates):
    """Pairs of 0.80 to 0.85: linked by the pipeline's stage, apart in op5."""
    assert matches(percent) == coordinates
    words = {i: [f"t{i}w{j}" for j in range(104)] for i in range(40)}  # 100 shingles
    pairs, n_linked = [], 0
    for i, base in words.items():
        other = base[: 104 - 8 - i % 8] + [f"x{i}y{j}" for j in range(8 + i % 8)]
        one, two = sets_of(" ".join(base)), sets_of(" ".join(other))
        assert 0.7 < len(one & two) / len(one | two) < 0.86
        n_linked += 100 * len(one & two) >= percent * len(one | two)
        pairs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert sum(not r.kept for r in near_duplicates(docs, percent).collect()) == n_linked
    if percent == 80:
        assert n_linked > 10 and corpus_pipeline.near_dedup(spark, docs, "").count() == 80 - n_linked
