"""Packing documents into sequences of a fixed length: cutting stock by column generation.

Each document is tokenized and cut where it exceeds a sequence. The lengths of the pieces form a histogram with a
bounded number of classes, whatever the number of pieces, and only that reaches the driver. There a linear program
chooses how often to use each pattern (how many pieces of each class fill a sequence together); a knapsack dynamic
program finds the pattern that the current prices want most, until none helps. Patterns are rounded down, what is
left over is filled largest first, and Spark hands the places of the patterns to the pieces by their rank within
their class. A class may hold most pieces: ranks are numbered in parts of bounded size with an offset for each part.

Defined results: a null or empty text is one piece with the end token only. Rows that repeat a document are packed
each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterator
from string import punctuation
from struct import pack as pack_numbers
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywright.llm.common import stored, sums_before

CAPACITY, END = 2048, 1
#: lengths up to EXACT are classes of their own, longer ones are rounded up to a multiple of STEP
EXACT, STEP = 32, 16
#: column generation ends when the number of sequences is proven to be within this share of the least possible
GAP = 0.002
#: pieces that one task numbers
PART = 50_000
#: words whose ids a task keeps at once, characters that it splits together, and new words in one call
KEPT_WORDS, TOGETHER, AT_ONCE = 800_000, 1 << 23, 512
#: how the tokenizer must normalize and split for letters to go to its model at once
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
#: Latin, Greek and Cyrillic, where all versions of Unicode agree on letters and case
_OLD_SCRIPTS = re.compile("[a-z\xaa-\u052f]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The character that a byte-level model has for each byte: itself if it prints, else one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(256)
    return {byte: chr(byte if byte in prints else next(others)) for byte in range(256)}


BYTE_LETTERS = _byte_letters()


class Words:
    """Ids of texts by a tokenizer that treats white space as nothing but a border: word by word, each word once."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self._use(Tokenizer.from_file(path))

    def _use(self, tokenizer) -> None:
        self._tokenizer = tokenizer
        # strings that stand for one token, in this case only
        self._special = [t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()]
        parts = [part and json.loads(part.__getstate__()) for part in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
        self._apart = parts == [NORMALIZER, SPLITTER] and not any(s.rstrip(punctuation).isalpha() for s in self._special)
        self._ids: dict[str, bytes] = {}

    def _plain(self, text: str) -> str:
        # the tokenizer normalizes and then ignores case; where that order, a final sigma or a special string matters, it
        # gets the text as it is
        if "Σ" not in text:
            lower = text.lower()
            as_it_is = any(s in lower for s in self._special)
            if not as_it_is and (text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", lower))):
                text = lower
        return text.replace("\n", " ")

    def _learn(self, new: list[str]) -> None:
        """Ids of new words."""
        ids = self._ids
        # punctuation after letters alone is a token of its own, so the letters' ids do; not after letters that
        # the tokenizer takes apart, whose marks join it
        ends, needed = [], set()
        for word in new:
            letters = word.rstrip(punctuation) if self._apart else word
            if len(letters) < len(word) and letters.isalpha() and (letters.isascii() or self._stays(letters)):
                ends.append((word, letters))
                needed.add(letters)
                needed.add(word[len(letters) :])
            else:
                needed.add(word)
        needed = needed.difference(ids)
        whole = set(filter(self._in_model, needed)) if self._apart else set()
        self._learn_letters(whole)
        self._learn_any(list(needed - whole))
        for word, letters in ends:
            ids[word] = ids[letters] + ids[word[len(letters) :]]

    @staticmethod
    def _in_model(word: str) -> bool:
        """Whether the tokenizer leaves a word as it is and in one piece: small letters, normalized."""
        if word.isascii():
            return word.isalpha() and word.islower()
        return bool(word.isalpha() and _OLD_SCRIPTS(word) and word == word.lower() and is_normalized("NFC", word))

    @staticmethod
    def _stays(letters: str) -> bool:
        """Whether letters stay letters without marks, normalized and in small: a dotted capital I does not."""
        return is_normalized("NFC", letters) and letters.lower().isalpha()

    def _learn_letters(self, words: set[str]) -> None:
        """Words that are one piece go to the model at once, without the steps before it."""
        tokenize = self._tokenizer.model.tokenize
        for word in words:
            found = tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS))
            self._ids[word] = pack_numbers(f"<{len(found)}I", *[t.id for t in found])

    def _learn_any(self, words: list[str]) -> None:
        """Many words in one call: the offsets of the tokens tell whose they are."""
        groups = [words[at : at + AT_ONCE] for at in range(0, len(words), AT_ONCE)]
        for group, found in zip(groups, self._tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)):
            starts = np.cumsum([0, *(len(w) + 1 for w in group)])
            cuts = (4 * np.searchsorted([at for at, _ in found.offsets], starts)).tolist()
            numbers = np.array(found.ids, "<u4").tobytes()
            for word, start, end in zip(group, cuts, cuts[1:]):
                self._ids[word] = numbers[start:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if not texts:
            return []
        words = pc.split_pattern(pa.array(map(self._plain, texts), pa.large_string()), " ")
        borders = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        del words
        distinct = coded.dictionary.to_pylist()
        if len(self._ids) > KEPT_WORDS:
            self._ids.clear()
        self._learn([w for w in distinct if w not in self._ids])
        ids = pa.array([self._ids[w] for w in distinct], pa.large_binary()).take(coded.indices)
        _, at, numbers = ids.buffers()  # the ids of all words, one after the other
        cuts = np.frombuffer(at, np.int64)[borders].tolist()
        numbers = numbers or pa.py_buffer(b"")
        return [numbers[start:end].to_pybytes() for start, end in zip(cuts, cuts[1:])]


def _slices(text: str) -> list[str]:
    """A long text in slices that end at a blank, so that memory does not follow its length."""
    found = []
    while len(text) > TOGETHER and (at := max(text.rfind(" ", 0, TOGETHER), text.rfind("\n", 0, TOGETHER))) > 0:
        found.append(text[:at])
        text = text[at:]
    return [*found, text]


def _encoded(words: Words, texts: Iterator[str]) -> Iterator[bytes]:
    """The ids of each text, in turn."""
    held: list[str] = []
    counts: list[int] = []

    def flush() -> Iterator[bytes]:
        parts = iter(words.encode(held))
        yield from [b"".join(itertools.islice(parts, n)) for n in counts]
        held.clear(), counts.clear()

    size = 0
    for text in texts:
        slices = _slices(text)
        held += slices
        counts.append(len(slices))
        size += len(text)
        if size > TOGETHER:
            yield from flush()
            size = 0
    yield from flush()


def _cutter(path: str, capacity: int, with_ids: bool):
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(path)
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
        for batch in batches:
            found = []
            for doc_id, ids in zip(batch["doc_id"], _encoded(words, (t or "" for t in batch["text"]))):
                ids += end
                for start in range(0, len(ids), 4 * capacity):
                    piece = ids[start : start + 4 * capacity]
                    row = (doc_id, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    found.append((*row, np.frombuffer(piece, "<u4").astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(found, columns=columns)

    return cut


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents, in their order; ``with_ids`` adds the token ids."""
    schema = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    # ids pass as text: pandas has no integer column with nulls
    cut = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInPandas(
        _cutter(tokenizer, capacity, with_ids), schema
    )
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def class_of(length, step: int = STEP, exact: int = EXACT):
    """Length that a piece is planned with; a column or a number."""
    if isinstance(length, int):
        return length if length <= exact else -(-length // step) * step
    return F.when(length <= exact, length).otherwise(F.ceil(length / step) * step).cast("long")


def best_pattern(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: an unbounded knapsack by dynamic programming over the length used.

    Class by class, all lengths at once; a class is added in batches of 1, 2, 4 ... pieces, which make any number.
    """
    value, steps = np.zeros(capacity + 1), []
    for k in np.flatnonzero(prices > 1e-12):
        left, batch = capacity // int(lengths[k]), 1
        while left > 0:
            batch = min(batch, left)
            width = batch * int(lengths[k])
            gained = value[: capacity + 1 - width] + batch * prices[k]
            better = gained > value[width:] + 1e-12
            if better.any():
                steps.append((k, batch, width, better))
                value[width:] = np.where(better, gained, value[width:])
            left -= batch
            batch *= 2
    pattern, used = np.zeros(len(lengths), np.int64), capacity
    for k, batch, width, better in reversed(steps):
        if used >= width and better[used - width]:
            pattern[k] += batch
            used -= width
    return float(value[capacity]), pattern


def fractional_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP):
    """Patterns (columns) and how often the linear program uses each: a revised simplex with priced columns."""
    n = len(lengths)
    columns = np.diag(capacity // lengths).astype(float)  # to begin with, each class by itself
    inverse = np.diag(1 / np.diag(columns))
    uses = inverse @ demand
    while True:
        prices = inverse.sum(axis=0)
        value, pattern = best_pattern(lengths, prices, capacity)
        if value <= 1 + gap:  # uses.sum() / value is a lower bound
            return columns.astype(np.int64), uses
        direction = inverse @ pattern
        grows = direction > 1e-9
        ratios = np.full(n, np.inf)
        ratios[grows] = uses[grows] / direction[grows]
        # of equal ratios the row that is least in lexicographic order leaves: no basis comes twice
        ties = np.flatnonzero(ratios <= ratios.min() + 1e-12)
        out = int(min(ties, key=lambda i: tuple(inverse[i] / direction[i])))
        uses = uses - direction * ratios[out]
        uses[out] = ratios[out]
        uses[uses < 1e-9] = 0
        columns[:, out] = pattern
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {class: pieces}) for all patterns; together they have a place for every piece."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[k] for k in lengths.tolist()], np.int64)
    columns, uses = fractional_patterns(lengths, left.astype(float), capacity)
    chosen = []
    for column, often in zip(columns.T, uses):
        column = np.minimum(column, left)
        filled = column > 0
        if filled.any() and (times := min(int(often + 1e-9), int((left[filled] // column[filled]).min()))):
            chosen.append((times, column))
            left = left - times * column
    while left.any():  # a few patterns' worth: largest first
        room, column = capacity, np.zeros_like(left)
        for k in range(len(lengths) - 1, -1, -1):
            column[k] = min(left[k], room // lengths[k])
            room -= column[k] * lengths[k]
        filled = column > 0
        times = int((left[filled] // column[filled]).min())
        chosen.append((times, column))
        left = left - times * column
    return [(t, {int(lengths[k]): int(c[k]) for k in np.flatnonzero(c)}) for t, c in chosen]


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``capacity``."""
    spark = cut.sparkSession
    rows = stored(cut.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    step = STEP if capacity % STEP == 0 else 1
    narrow = rows.select("_piece", "length", class_of(F.col("length"), step).alias("_class"))
    histogram = {r[0]: r[1] for r in narrow.groupBy("_class").count().collect()}  # bounded by the capacity
    places, first, taken = [], 0, dict.fromkeys(histogram, 0)
    for times, pattern in plan(histogram, capacity):
        for k, each in pattern.items():
            places.append((k, taken[k], taken[k] + times * each, each, first))
            taken[k] += times * each
        first += times
    table = spark.createDataFrame(places, "_class long, _from long, _to long, _each long, _first long")
    parts = max(1, -(-sum(histogram.values()) // PART))
    part = F.pmod(F.xxhash64("_piece"), F.lit(parts))
    # the table has a row for each class of each pattern: bounded by the capacity, not by the pieces
    placed = (
        sums_before(narrow, ["_class"], part, ["_piece"], rank=F.lit(1))
        .join(F.broadcast(table), "_class").where("rank >= _from AND rank < _to")
        .select("_piece", "length", F.expr("_first + (rank - _from) div _each").alias("sequence_id"))
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_piece")
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.select("_piece", "sequence_id", F.coalesce(offset, F.lit(0)).alias("offset"))
    return rows.join(placed, "_piece").drop("_piece")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return pack(pieces(docs, tokenizer, capacity, with_ids), capacity)
