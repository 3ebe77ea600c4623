"""Packing against the tokenizer itself, an exact round trip, and the bounds of the cutting-stock plan."""

import random
import zlib
from types import SimpleNamespace

import numpy as np
import odd
import public_tokenizers
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from tallywright.llm import packing
from tallywright.llm.common import documents
from tallywright.llm.packing import Words, best_pattern, class_of, pack_documents, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, texts, tokenizer, capacity):
    """All ids are there once, in place, in gapless sequences. Texts may repeat under one id."""
    by_doc, sequences = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    expected = {}
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), capacity):
            piece = np.array(ids[start : start + capacity], "<u4")
            key = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
            expected[key] = expected.get(key, 0) + 1
    got = {}
    for r in rows:
        key = (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
        got[key] = got.get(key, 0) + 1
        if "ids" in r:
            assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert got == expected
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [2048, 60])
def test_round_trip(spark, tokenizer, capacity):
    docs = documents(spark, SMALL)
    rows = pack_documents(docs, PATH, capacity, with_ids=capacity == 60).collect()
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sequences = check(rows, texts, tokenizer, capacity)
    least = sum(r.length for r in rows) / capacity
    assert sequences <= 1.04 * least + 1  # padding


def test_odd_rows(spark, tokenizer):
    texts = [(r[0], r[1]) for r in odd.rows()]
    for docs in (odd.frame(spark), odd.clashing(spark)):
        check(pack_documents(docs, PATH).collect(), texts, tokenizer, 2048)
    assert pack_documents(odd.empty(spark), PATH).count() == 0


def test_one_length_for_all(spark, tokenizer, monkeypatch):
    """All pieces in one class, numbered in many parts."""
    monkeypatch.setattr(packing, "PART", 100)
    docs = spark.createDataFrame([(i, "the cat sat") for i in range(1500)], "doc_id long, text string")
    rows = pack_documents(docs, PATH).collect()
    assert check(rows, [(i, "the cat sat") for i in range(1500)], tokenizer, 2048) == 3


alphabet = st.text(st.sampled_from(list("aZé.,' \n\t\x1c\x85  ́ΣßİǰΩ1½!%<|>日한\U0001f600")) | st.characters(codec="utf-8"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(alphabet, max_size=5))
def test_words_like_the_tokenizer(texts):
    made = Tokenizer.from_file(PATH) if not hasattr(Words, "_made") else Words._made
    Words._made = made
    whole = [np.array(made.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    words = Words.__new__(Words)
    words._use(made)
    assert words.encode(texts) == whole


def test_special_strings_like_the_tokenizer(spark, tokenizer):
    texts = [
        "end <|endoftext|> more", "A<|endoftext|>B, <|startoftext|>.", "<|EndOfText|> Case", "<|endoftext|><|endoftext|>",
        "x\n<|endoftext|>\nΣ É", "<|endoftext", "no special, END", "|endoftext|>", "<|end oftext|>",
    ]
    words = Words(PATH)
    for _ in range(2):  # the second time from what is kept
        for text in (*texts, " ".join(texts)):
            assert words.encode([text]) == [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text
    assert np.frombuffer(words.encode([texts[0]])[0], "<u4").tolist() == [806, 49407, 750]
    rows = pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    check(rows, list(enumerate(texts)), tokenizer, 2048)


@pytest.mark.parametrize("end", ["", ",", ".", "x,"])
def test_words_that_change_when_normalized(tokenizer, end):
    words = Words(PATH)
    for word in ("ব\u09dc", "\u0958", "\ufb2a", "J\u030c", "H\u0331", "T\u0308", "W\u030a", "\u0399\u0308\u0301", "É", "E\u0301", "İ", "ΟΔΟΣ"):
        for text in (word + end, f"Plain {word}{end} and {word.lower()}{end}", f"a{word}{end}"):
            assert words.encode([text]) == [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text


def test_letters_go_to_the_model_at_once(tokenizer):
    """Only odd words, and each run of punctuation once, take the steps before the model."""
    texts = ["plain words, größer. été$$$ naïve!!", "слова, λέξη. words$$$ more!!", "nochmals größer, und été."]
    expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    words, sent = Words(PATH), []

    def encode_batch(groups, **options):
        sent.extend(w for group in groups for w in group.split(" "))
        return tokenizer.encode_batch(groups, **options)

    words._tokenizer = SimpleNamespace(model=tokenizer.model, encode_batch=encode_batch)
    assert words.encode(texts) == expected
    assert sorted(sent) == ["!!", "$$$", ",", "."]


def test_letters_of_old_scripts_like_the_tokenizer(tokenizer):
    words = Words(PATH)
    letters = [chr(c) for c in range(0x21, 0x530)]
    texts = [f"a{c}b {c}{c} x{c}{end} {c}{end}" for c in letters for end in ("", ".", "'s", "'", "<|", "1")]
    for text in (*texts, " ".join(texts)):
        assert words.encode([text]) == [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()], text


def test_another_tokenizer_takes_all_its_steps():
    """Words of letters go to the model at once only if the steps before it are known to leave them."""
    changes = [
        {"normalizer": normalizers.Lowercase()},
        {"normalizer": normalizers.Sequence([normalizers.NFC(), normalizers.Replace("o", "0"), normalizers.Lowercase()])},
        {"pre_tokenizer": pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Split("o", "isolated"), pre_tokenizers.ByteLevel(False, use_regex=False),
        ])},
    ]
    for change in changes:
        other = Tokenizer.from_file(PATH)
        for name, part in change.items():
            setattr(other, name, part)
        words = Words.__new__(Words)
        words._use(other)
        text = "foo, boots. food"
        assert words.encode([text, "", text]) == [
            np.array(other.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (text, "", text)
        ]


def test_no_texts_and_no_words():
    words = Words(PATH)
    assert words.encode([]) == [] and words.encode([""]) == [b""] and words.encode(["", " ", "\n"]) == [b""] * 3


def test_long_texts_in_slices(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 50)
    text = "some words, and\nmore of them. " * 20 + "x" * 120
    words = Words(PATH)
    got = list(packing._encoded(words, iter([text, "", "one"])))
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (text, "", "one")]


def test_best_pattern_is_the_best():
    rng = random.Random(3)
    for _ in range(30):
        n, capacity = rng.randrange(1, 7), rng.randrange(5, 60)
        lengths = np.array(sorted(rng.sample(range(1, capacity + 1), min(n, capacity))))
        prices = np.array([rng.random() for _ in lengths])
        value, pattern = best_pattern(lengths, prices, capacity)
        best = [0.0] * (capacity + 1)
        for used in range(1, capacity + 1):
            best[used] = max([best[used - 1], *(best[used - k] + p for k, p in zip(lengths, prices) if k <= used)])
        assert value == pytest.approx(best[capacity])
        assert (pattern * lengths).sum() <= capacity and (pattern * prices).sum() == pytest.approx(value)


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {2048: 5}, {1025: 7}, {704: 300, 688: 300, 656: 300}, {16: 5000, 2000: 40}])
def test_plan_has_a_place_for_each_and_few_sequences(histogram):
    chosen = plan(histogram, 2048)
    for k, n in histogram.items():
        assert sum(t * p.get(k, 0) for t, p in chosen) >= n
    assert all(sum(k * n for k, n in p.items()) <= 2048 for _, p in chosen)
    least = sum(k * n for k, n in histogram.items()) / 2048
    if set(histogram) != {1025}:
        assert sum(t for t, _ in chosen) <= 1.01 * least + 2


def test_class_holds_its_lengths():
    assert all(n <= class_of(n) <= n + packing.STEP - 1 for n in range(1, 2049)) and class_of(2048) == 2048
