"""The manifest against a tree hashed from scratch, with several rounds of subtrees, and odd tables."""

import hashlib
import re

import odd
import pytest
from pyspark.sql import functions as F

from tallywright.llm import merkle
from tallywright.llm.merkle import Subtree, prove


def lower():
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"text": F.when(F.col("doc_id") % 3 == 0, text).otherwise(F.col("text"))}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(row):
    doc_id, text = row[0], row[4]
    if doc_id is None or doc_id % 3 or text is None:
        return row
    return (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), text))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    found = []
    for level in levels[:-1]:
        start = at // 16 * 16
        found.append((level[start:at], level[at + 1 : start + 16]))
        at //= 16
    return found


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    ordered = [sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in group]) for group in ordered]
    top = tree([t[-1][0] for t in trees])
    result = []
    for nth, (group, own) in enumerate(zip(ordered, trees)):
        for at, row in enumerate(group):
            whole = path(own, at) + path(top, nth)
            folded = leaf(lowered(row))
            for left, right in whole:
                folded = h(*left, folded, *right)
            proof = h(*("".join(left + right) for left, right in whole))
            root = top[-1][0]
            result.append((row[0], leaf(row), own[-1][0], root, proof, folded, folded == root))
    return sorted(result, key=repr)


def check(df, rows):
    got = prove(df, lower())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.fixture(params=[1, 2, 3])
def levels(request, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", request.param)
    monkeypatch.setattr(merkle, "SPAN", merkle.RUN**request.param)


def test_a_large_source_and_many_small_ones(spark, levels):
    rows = [(i, "hot" if i % 3 else f"s{i}", "en", i, f"Text {i} of MANY") for i in range(700)]
    check(spark.createDataFrame(rows, odd.COLUMNS.replace("text string, lang string, source string, n_chars long", "source string, lang string, n_chars long, text string")).repartition(5), rows)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_lengths_around_full_runs(spark, n):
    rows = [(i, None, None, None, f"A{i}") for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), rows)


def test_odd_rows(spark):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in odd.rows()]
    check(odd.frame(spark), rows)
    check(odd.clashing(spark), rows)
    assert prove(odd.empty(spark)).collect() == []
    assert all(r.verified for r in prove(odd.frame(spark)).collect())


def test_a_fold_hashes_no_left_sibling():
    tree_ = Subtree([str(i).encode() for i in range(40)], 40)
    siblings = [(None, right) for _, right in tree_.siblings(20)]  # left ones are not needed
    changed = [str(i).encode() for i in range(40)]
    changed[20] = b"other"
    assert tree_.fold(20, b"other", siblings) == Subtree(changed, 40).top
    assert tree_.fold(20, b"20", siblings) == tree_.top
