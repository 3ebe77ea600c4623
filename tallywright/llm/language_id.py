"""Language of a text: multinomial naive Bayes over hashed character n-grams.

Counting runs on Spark over a bounded sample of labelled rows; what reaches the driver is one count for each
language and n-gram slot, bounded by ``SLOTS``, and the matrix of log probabilities made of it is broadcast.
Texts are scored in batches: the n-grams of a batch are one sparse matrix (document boundaries and slot numbers),
multiplied with the matrix by summing the rows that each document selects.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for every text if there was
nothing to learn from. Languages that tie go to the first by code point. Other columns pass
through; one of the same name as a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import free, small_batches

#: slots that n-grams are hashed to; lengths of the n-grams; labelled rows learned from, for each language
SLOTS, LENGTHS, ROWS_PER_LANGUAGE = 1 << 15, (1, 2, 3), 2000
#: characters that are handled at once, so that neither a long text nor a full batch needs much memory
PIECE = 1 << 20
#: slots of short texts that are summed at once: each takes eight bytes for itself and for each language
HELD = 1 << 17


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _slots(text: str, is_letter: np.ndarray) -> np.ndarray:
    """Slots of the n-grams in one piece; other characters than letters are one gap between words."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = is_letter[points]
    if not letter.any():
        return np.empty(0, np.int64)
    points = np.where(letter, points, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of several other characters stays as the gap
    points = np.concatenate(([0], points[keep], [0])).astype(np.uint64)
    found = []
    code = np.zeros(len(points), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        code = code[: len(points) - n + 1] * np.uint64(0x110001) + points[n - 1 :]
        if n in LENGTHS:
            mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64))
    return np.concatenate(found)


def _pieces(text: str) -> Iterator[str]:
    return (text[at : at + PIECE] for at in range(0, len(text), PIECE))


def _counter(is_letter):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch["lang"], batch["text"]):
                sums = seen.setdefault(language, np.zeros(SLOTS, np.int64))
                for piece in _pieces(text):
                    sums += np.bincount(_slots(piece, is_letter.value), minlength=SLOTS)
        for language, sums in seen.items():
            at = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": language, "slot": at, "n": sums[at]})

    return count


class Model(NamedTuple):
    """Names of the languages, the log probability of each n-gram slot in each, and which points are letters."""

    names: list[str]
    weights: np.ndarray
    letters: np.ndarray


def classify(texts: list[str | None], names, weights, is_letter) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its probability among those learned."""
    sums, any_letter = np.zeros((len(texts), len(names))), np.zeros(len(texts), bool)
    held: list[np.ndarray] = []
    owners: list[int] = []

    def add() -> None:
        if held:
            starts = np.cumsum([0, *map(len, held[:-1])])
            np.add.at(sums, owners, np.add.reduceat(weights[np.concatenate(held)], starts, axis=0, dtype=np.float64))
            held.clear(), owners.clear()

    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            if len(slots := _slots(piece, is_letter)):
                any_letter[i] = True
                held.append(slots)
                owners.append(i)
                size += len(slots)
                if size > HELD:
                    add()
                    size = 0
    add()
    if not names:
        return ["und"] * len(texts), [0.0] * len(texts)
    best = sums.argmax(axis=1)
    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    return (
        [names[k] if known else "und" for k, known in zip(best, any_letter)],
        [float(p) if known else 0.0 for p, known in zip(share, any_letter)],
    )


def learn(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learns from rows with a text and a language: of each about ``rows_per_language``, drawn by a hash of the id."""
    is_letter = letters()
    shared = docs.sparkSession.sparkContext.broadcast(is_letter)
    known = docs.select("doc_id", "lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    # one row for each language; the sample is taken where the rows are, without moving a text
    shares = known.groupBy("lang").agg(F.count("*").alias("rows"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    sample = known.join(F.broadcast(shares), "lang").where(place * F.col("rows") < rows_per_language)
    counts = (
        sample.select("lang", "text")
        .mapInPandas(_counter(shared), "lang string, slot long, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    names = sorted(counts["lang"].unique())
    sums = np.full((SLOTS, len(names)), 0.5)
    sums[counts["slot"].to_numpy(), counts["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(int)] += counts["n"]
    return Model(names, np.log(sums / sums.sum(axis=0)).astype(np.float32), is_letter)


def language_of(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct of ``lang_pred`` and ``score`` for each text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("lang_pred string, score double")
    def score(texts: pd.Series) -> pd.DataFrame:
        names, scores = classify(texts.tolist(), *shared.value)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return score(F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the documents that nothing is learned from. A null id belongs to it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Adds ``held_out``, ``lang_pred`` and ``score``, learned from the rows that are not held out."""
    model = learn(docs.where(~held_out()), rows_per_language)
    (found,) = free(docs, "language")
    result = docs.withColumn(found, language_of(docs, model))
    return result.withColumns(
        {"held_out": held_out(), "lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}
    ).drop(found)


def in_a_language(docs: DataFrame) -> DataFrame:
    """The documents that have a language: texts without a single letter go, also if no language was learned."""
    small_batches(docs.sparkSession)
    model = learn(docs.where(~held_out()))
    if not model.names:  # one language of equal weights: what is left is whether there is a letter
        model = Model(["any"], np.zeros((SLOTS, 1), np.float32), model.letters)
    return docs.where(language_of(docs, model)["lang_pred"] != "und")
