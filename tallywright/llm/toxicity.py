"""Toxic texts by compression distance, with one zstandard dictionary of toxic and one of ordinary text.

A window is one word, or a part of a long run of letters, repeated so that the fixed cost of a compressed block does not hide the
difference. It is compressed with each dictionary by itself, and without one where a dictionary makes it longer; its distance is
what the toxic dictionary saves beyond the ordinary one. A text is scored by the share of its windows that save at least ``saves``
bytes, against a share calibrated on rows that neither dictionary was made from.

The dictionaries are trained on a bounded sample of labelled rows (``ROWS_PER_CLASS``): the ordinary one on
stretches of ordinary text; the toxic one holds the words of toxic text that are, or start with, what a much larger
share of toxic than of ordinary documents has, since what both share says nothing. Words and stems are chosen among the rows of each language (``lang``,
where the table has it) and among all rows together, so that the words of a rare language are not too rare to count,
and the dictionary is as large as what is found. Words are counted on Spark; the driver gets the bounded training
material and one number for each calibration row and threshold.

Defined results: a null or empty text, or one without letters, scores 0; so does every text if no row is labelled
toxic. Repeated labels of a document count once; a null label is none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: labelled rows of each class that are learned from, and stretches of ordinary text in its dictionary's training
ROWS_PER_CLASS, STRETCHES, STRETCH = 5000, 20_000, 400
ORDINARY_BYTES = 32_768
#: a word or stem is typical of toxic text if its share of toxic documents is this many times that of the others, and
#: so large, among rows of a language; most of them that are taken from one language
TYPICAL_RATIO, TYPICAL_SHARE, TYPICAL_WORDS = 3.0, 0.02, 500
#: lengths of word stems
STEMS = range(4, 9)
#: words and stems of a language that the driver chooses from
CANDIDATES = 20_000
#: words in the toxic dictionary; what follows them, as zstandard finds nothing that starts in a dictionary's last bytes
TOXIC_WORDS, PAD = 4000, "\n" * 16
REPEATS, LEVEL, SAVES = 4, 9, (2, 3, 4, 5)  # lower levels index a dictionary's places in part only
#: words added to each text's count, so that one word of a short text proves little
PRIOR_WORDS = 20
#: distances of so many words are kept at once in a worker
KEPT_WORDS = 200_000

#: characters of a window, and of one in scripts that put no blanks between words; the windows of a run overlap
WIDTH, UNSPACED_WIDTH = 64, 8
#: lengths of the character n-grams that stand for stems there
UNSPACED_STEMS = range(2, 5)

_WORD = re.compile(r"[^\W\d_]+")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class Model(NamedTuple):
    """The two dictionaries, the bytes that a toxic window saves, and the share of such windows that scores 0.5."""

    ordinary: bytes
    toxic: bytes
    saves: int
    share: float


class Distances(dict):
    """Bytes that the toxic dictionary saves on a word, worked out when first asked for."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        super().__init__()
        self._squeeze = [self._compressor(ordinary), self._compressor(toxic)]
        self._alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self._known = {toxic[i : i + 4] for i in range(len(toxic) - 3)}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        window = f" {word} "
        saved = 0
        content = window.encode("utf-8", "surrogatepass")
        # what shares no four bytes with the toxic dictionary cannot be shortened by it
        if any(content[i : i + 4] in self._known for i in range(len(content) - 3)):
            # a dictionary that makes a window longer is none for it
            most = len(self._alone.compress(content * REPEATS))
            ordinary, toxic = (min(most, len(c.compress(content * REPEATS))) for c in self._squeeze)
            saved = ordinary - toxic
        self[word] = saved
        return saved


def _words(text: str | None) -> list[str]:
    """The words of a text; a long run of letters in overlapping windows that cover all of it."""
    lower = (text or "").lower()
    found = _WORD.findall(lower)
    unspaced = not lower.isascii() and _UNSPACED.search(lower)
    if not unspaced and max(map(len, found), default=0) <= WIDTH:
        return found
    windows = []
    for run in found:
        width = UNSPACED_WIDTH if unspaced and _UNSPACED.search(run) else WIDTH
        step = width // 2
        windows += (run[at : at + width] for at in range(0, max(1, len(run) - width + step), step))
    return windows


def _trained(size: int, samples: list[bytes]) -> bytes:
    """Content of a dictionary; too few samples to choose from are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _features(words: list[str]) -> set[str]:
    """The words, each with the blank that ends it, and their stems."""
    found = set()
    for word in set(words):
        found.add(word + " ")
        found.update(word[:n] for n in STEMS if n <= len(word))
        if not word.isascii() and _UNSPACED.search(word):
            found.update(word[at : at + n] for n in UNSPACED_STEMS for at in range(len(word) - n + 1))
    return found


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many texts of each class have a feature, for the texts of one batch and language."""
    for batch in batches:
        counts: dict[str, tuple[Counter, Counter]] = {}
        for language, text, toxic in zip(batch["language"], batch["text"], batch["toxic"]):
            counts.setdefault(language, (Counter(), Counter()))[int(toxic)].update(_features(_words(text)))
        for language, (ordinary, toxic) in counts.items():
            names = list(ordinary.keys() | toxic.keys())
            yield pd.DataFrame(
                {"language": language, "feature": names, "toxic": [toxic[x] for x in names], "ordinary": [ordinary[x] for x in names]}
            )


def _typical(fit: DataFrame) -> list[str]:
    """Features typical of toxic text, of each language and of all rows together."""
    rows = fit.groupBy("language").agg(F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_ordinary"))
    counts = fit.select("language", "text", "toxic").mapInPandas(_feature_rows, "language string, feature string, toxic long, ordinary long")
    counts = counts.groupBy("language", "feature").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    # null stands for all languages together
    counts = counts.unionByName(counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")), True)
    rows = rows.unionByName(rows.agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_ordinary").alias("n_ordinary")), True)
    counts = counts.where("toxic >= 2").withColumnRenamed("language", "of")
    # a row for each language of the bounded sample
    known = counts.join(F.broadcast(rows), F.col("of").eqNullSafe(F.col("language"))).drop("language")
    share, usual = F.col("toxic") / F.col("n_toxic"), (F.col("ordinary") + 0.5) / (F.col("n_ordinary") + 1)
    expected = usual * F.col("n_toxic")
    # bounds the probability that ordinary texts would have it as often: less than one among all that were counted
    evidence = F.col("toxic") * F.log(F.col("toxic") / expected) - F.col("toxic") + expected
    tried = known.groupBy("of").agg(F.log(F.count("*")).alias("tried")).withColumnRenamed("of", "language")
    known = known.join(F.broadcast(tried), F.col("of").eqNullSafe(F.col("language")))
    gain = share - TYPICAL_RATIO * usual
    best = Window.partitionBy("of").orderBy(F.desc("gain"), F.desc(F.length("feature")), "feature")
    found = (
        known.where((gain > 0) & (share >= TYPICAL_SHARE) & (evidence > F.col("tried")))
        .withColumn("gain", gain).withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= CANDIDATES)
        .select("of", "feature", "nth").orderBy("of", "nth").toPandas()
    )
    chosen: set[str] = set()
    for _, group in found.groupby("of", sort=False, dropna=False):
        own: set[str] = set()
        covered: set[str] = set()
        for feature in group["feature"]:
            # one of several stems of the same words
            if len(own) < TYPICAL_WORDS and feature not in covered and own.isdisjoint(feature[:n] for n in range(1, len(feature))):
                own.add(feature)
                covered.update(feature[:n] for n in range(1, len(feature) + 1))
        chosen |= own
    return sorted(chosen)


def _ordinary_rows(typical: frozenset[str]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                # what is typical of toxic text is for the toxic dictionary to save
                whole = " ".join(w for w in _words(text) if typical.isdisjoint(_features([w])))
                yield pd.DataFrame({"stretch": [whole[i : i + STRETCH] for i in range(0, len(whole), STRETCH)]}, dtype=str)

    return rows


def _toxic_words(typical: frozenset[str]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                yield pd.DataFrame({"word": [w for w in set(_words(text)) if not typical.isdisjoint(_features([w]))]}, dtype=str)

    return rows


def _saved_rows(ordinary: bytes, toxic: bytes):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distances = Distances(ordinary, toxic)
        for batch in batches:
            found = []
            for text, label in zip(batch["text"], batch["toxic"]):
                saved = np.array([distances[w] for w in _words(text)], np.int64)
                found.append((label, len(saved), *(int((saved >= k).sum()) for k in SAVES)))
            yield pd.DataFrame(found, columns=["toxic", "n", *(f"s{k}" for k in SAVES)])

    return rows


def _calibrated(rows: pd.DataFrame) -> tuple[int, float]:
    """The bytes and the share of windows that tell most rows apart; toxic and ordinary rows weigh as they are."""
    best = (-1.0, max(SAVES), 1.0)
    toxic = rows["toxic"].to_numpy(bool)
    for k in SAVES:
        shares = rows[f"s{k}"].to_numpy() / (rows["n"].to_numpy() + PRIOR_WORDS)
        order = np.argsort(-shares, kind="stable")
        right = np.cumsum(np.where(toxic[order], 1, -1))  # rows told right if the first so many are called toxic
        ends = np.flatnonzero(np.append(np.diff(shares[order]) < 0, True)) if len(order) else []
        for at in ends:
            low, high = (shares[order[at + 1]] if at + 1 < len(order) else 0.0), shares[order[at]]
            if high > 0 and right[at] > best[0]:
                best = (float(right[at]), k, (low + high) / 2)
    return best[1], best[2]


def _part(n: int) -> Column:
    """Whether crc32 of the id, modulo 5, is ``n``. A null id counts as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5, F.lit(0)) == n


def learn(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model | None:
    """Learns from labelled rows that are not held out; a part of them only calibrates."""
    named = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~_part(0)).dropDuplicates(["doc_id"])
    ids = [
        named.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for k in (0, 1)
    ]
    # at most twice rows_per_class ids
    language = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    rows = docs.select("doc_id", "text", language.alias("language")).join(F.broadcast(ids[0].unionByName(ids[1]).select("doc_id", "toxic")), "doc_id")
    fit, check = rows.where(~_part(1)), rows.where(_part(1))
    n = {bool(r["toxic"]): r["count"] for r in fit.groupBy("toxic").count().collect()}
    if not n.get(True) or not n.get(False):
        return None
    typical = _typical(fit)
    ordinary = (
        fit.where("toxic = 0").select("text").mapInPandas(_ordinary_rows(frozenset(typical)), "stretch string")
        .orderBy(F.xxhash64("stretch"), "stretch").limit(STRETCHES).toPandas()["stretch"]
    )
    # the commonest words last, where they are nearest
    toxic = (
        fit.where("toxic = 1").select("text").mapInPandas(_toxic_words(frozenset(typical)), "word string")
        .groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(TOXIC_WORDS).toPandas()["word"]
    )
    dictionaries = (
        _trained(ORDINARY_BYTES, [x.encode("utf-8", "surrogatepass") for x in ordinary]),
        f" {' '.join(reversed(toxic.tolist()))} {PAD}".encode("utf-8", "surrogatepass") if len(toxic) else b"",
    )
    if not all(dictionaries):
        return None
    columns = ", ".join(f"s{k} long" for k in SAVES)
    saved = check.select("text", "toxic").mapInPandas(_saved_rows(*dictionaries), f"toxic long, n long, {columns}")
    return Model(*dictionaries, *_calibrated(saved.toPandas()))


def toxicity(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    """Score of each text, from 0 to 1; 0.5 and more is called toxic."""
    if model is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ordinary, toxic, saves, share = shared.value
        distances = Distances(ordinary, toxic)
        for texts in batches:
            scores = []
            for body in texts:
                words = _words(body)
                found = sum(distances[w] >= saves for w in words) / (len(words) + PRIOR_WORDS)
                scores.append(found / (found + share))
            yield pd.Series(scores, dtype=float)

    return score(F.col(text))


def scored(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """Adds ``held_out``, ``score`` and ``predicted``."""
    model = learn(docs, labels, rows_per_class)
    return docs.withColumn("score", toxicity(docs, model)).withColumns(
        {"held_out": _part(0), "predicted": (F.col("score") >= 0.5).cast("int")}
    )
