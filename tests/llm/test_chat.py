"""Chat formatting: round trips, masks, templates that rewrite history, long conversations, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallywright.llm.chat import (
    Incremental, conversation_digests, escape, format_conversations, marked_turns, read_back, unescape,
)

COLUMNS = "conv_id long, turn long, role string, text string"
PIECES = ["<", "|", "\\", "<|im_start|>", "<|im_end|>", "\n", "a", "assistant", "<|", "<\\|", "\\n", "é", "\U0001f600", " "]


def texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(20))
def test_escaping_is_reversible_and_leaves_no_control_string(seed):
    turns = list(zip(texts(30, seed), texts(30, seed + 100)))
    for _, text in turns:
        assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert read_back(marked_turns(turns)) == turns


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def expected(rows):
    conversations = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        conversations.setdefault(conv_id, []).append((role or "", text or ""))
    return sorted((
        (
            conv_id, len(turns), sha(f"{role}\n{text}\n" for role, text in turns),
            sum(len(text) for role, text in turns if role == "assistant"),
            sha(text for role, text in turns if role == "assistant"), len(marked_turns(turns)), False,
        )
        for conv_id, turns in conversations.items()
    ), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_digests_are_read_back_from_the_output(spark):
    rng = random.Random(7)
    rows = [(i % 23, rng.randrange(50), rng.choice(["user", "assistant", "system"]), text) for i, text in enumerate(texts(400, 3))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (99, None, None, None), (99, 0, "as\\sis\ntant", "<|"), (2**60 + 1, 0, "assistant", "y")]
    rows += [(5, 1, "assistant", "twice")] * 2 + [(6, 0, "user", "long " * 50_000)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(6)
    assert rows_of(conversation_digests(format_conversations(df))) == expected(rows)
    clashing = df.withColumns({c: F.lit("kept") for c in ("nth", "formatted", "start", "in_loss", "text_start")})
    assert rows_of(conversation_digests(format_conversations(clashing))) == expected(rows)
    empty = spark.createDataFrame([], COLUMNS)
    assert format_conversations(empty).collect() == [] and conversation_digests(format_conversations(empty)).collect() == []


def test_one_conversation_with_most_rows(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i} <|im_end|>") for i in range(500)] + [(i, 0, "user", "hi") for i in range(2, 40)]
    got = format_conversations(spark.createDataFrame(rows, COLUMNS).repartition(4))
    assert rows_of(conversation_digests(got)) == expected(rows)
    pieces = [r.formatted for r in sorted(got.where("conv_id = 1").collect(), key=lambda r: r.nth)]
    assert "".join(pieces) == marked_turns([(r[2], r[3]) for r in rows if r[0] == 1])


def test_spans_of_a_template_with_a_header_and_without_escapes():
    def plain(turns):
        return "<s>" + "".join(f"[{role}]{text}[/]" for role, text in turns)

    conversation = Incremental(plain, 16, lambda text: text)
    assert conversation.add("user", "ab") == ("<s>[user]ab[/]", 3, 9, 11, True, None)
    assert conversation.add("assistant", "") == ("[assistant][/]", 0, 11, 11, True, None)


def test_a_template_that_rewrites_history_is_found(spark):
    def forgets(turns):  # drops the thoughts of all turns but the last
        return "".join(f"{role}:{text if i == len(turns) - 1 else text.split('#')[-1]};" for i, (role, text) in enumerate(turns))

    def trims(turns):  # changes texts
        return "".join(f"{role}:{text.strip()};" for role, text in turns)

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "why#b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (2, 0, "assistant", " e ")]
    df = spark.createDataFrame(rows, COLUMNS)
    got = {(r.conv_id, r.nth): r for r in format_conversations(df, forgets, lambda text: text).collect()}
    assert [got[1, i].rewritten_at for i in range(4)] == [None, None, len("user:a;assistant:"), None]
    assert [got[1, i].in_loss for i in range(4)] == [False, True, False, True]
    got = {(r.conv_id, r.nth): r for r in format_conversations(df, trims, lambda text: text).collect()}
    assert not got[2, 0].in_loss and got[2, 0].text_start is None and got[1, 1].in_loss


@pytest.mark.parametrize("restart", [1, 2, 7])
def test_restarts_change_nothing(restart):
    turns = list(zip(["user", "assistant"] * 30, texts(60, 9)))
    whole, parts = Incremental(marked_turns, 100, unescape), Incremental(marked_turns, restart, unescape)
    assert [whole.add(*t) for t in turns] == [parts.add(*t) for t in turns]


def test_history_is_compared_from_the_first_turn_on(spark):
    def forgets_the_first(turns):  # once there are 50 turns
        return "".join(f"{role}:{'' if i == 0 and len(turns) >= 50 else text};" for i, (role, text) in enumerate(turns))

    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(60)]
    got = format_conversations(spark.createDataFrame(rows, COLUMNS), forgets_the_first, lambda text: text).collect()
    assert [(r.nth, r.rewritten_at) for r in got if r.rewritten_at is not None] == [(49, len("user:"))]
    assert [r.nth for r in got if r.role == "assistant" and not r.in_loss] == [49]
