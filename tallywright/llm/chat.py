"""Chat formatting by black-box rendering of turn prefixes, with spans, a loss mask and a check for rewritten history.

A template is any function from a list of (role, text) to a string; nothing is known of its insides. A conversation is
rendered turn by turn: the output for the first k turns is compared with the one for k + 1. What was added is the span
of the new turn. If the earlier output is no longer a prefix, the template has rewritten history, and the place where the
outputs part is reported. Inside a span the text is found the same way: the last turn is rendered once more with two
texts of one letter; up to their first difference goes the turn's opening, after it its closing.

Turns are streamed in order through the tasks. Every prefix is rendered from the first turn on, since a template may look
back any distance: a task holds the turns of one conversation, and the time grows with the square of their number.
Where a template is known to look back at most ``restart`` turns, that parameter keeps only so many of them.

Defined results: a null text or role counts as empty. Rows of a null conversation are one conversation. Turns follow
their number, null first, then role and text; rows that repeat a turn are turns of their own. Other columns are ignored.
A turn after which history was rewritten, or whose text cannot be read back, is under no loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
LOSS_ROLES = ("assistant",)

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*?)" + re.escape(CLOSE) + r"\n", re.DOTALL)

FORMATTED = {
    "conv_id": pa.int64(), "nth": pa.int64(), "role": pa.string(), "formatted": pa.string(), "start": pa.int64(),
    "text_start": pa.int64(), "text_end": pa.int64(), "in_loss": pa.bool_(), "rewritten_at": pa.int64(),
}
DIGESTS = {
    "conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
    "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "rewrites_history": pa.bool_(),
}
_SQL_NAME = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}


def _schema(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {_SQL_NAME[kind]}" for name, kind in columns.items())


def escape(text: str) -> str:
    """Takes the power from control strings: a backslash more between ``<`` and ``|``."""
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@lru_cache(1024)
def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def marked_turns(turns: Turns) -> str:
    """The template of the query: every turn between marks, control strings inside texts escaped."""
    return "".join(f"{OPEN}{_escape_role(role)}\n{escape(text)}{CLOSE}\n" for role, text in turns)


def read_back(formatted: str) -> Turns:
    """The turns of a formatted string."""
    return [(_unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def text_span(render: Callable[[Turns], str], before: Turns, role: str, output: str) -> tuple[int, int]:
    """Where the text of the last turn stands in ``output``, its rendering after the turns ``before``."""
    a, b = (render([*before, (role, letter)]) for letter in "ab")
    opening = len(commonprefix([a, b]))
    return opening, len(output) - (len(a) - opening - 1)


class Incremental:
    """One conversation, turn by turn."""

    def __init__(self, render: Callable[[Turns], str], restart: int | None, original: Callable[[str], str]):
        self.render, self.restart, self.original = render, restart, original
        self.turns: Turns = []
        self.output = render([])
        self.first = True

    def add(self, role: str, text: str) -> tuple:
        """formatted, start (of the turn in it), text_start, text_end, whether the text reads back, rewritten_at."""
        if self.restart and len(self.turns) >= 2 * self.restart:
            self.turns = self.turns[-self.restart :]
            self.output = self.render(self.turns)
        output = self.render([*self.turns, (role, text)])
        shared = len(self.output) if output.startswith(self.output) else len(commonprefix([self.output, output]))
        rewritten = None if shared == len(self.output) else shared
        begin, end = text_span(self.render, self.turns, role, output)
        readable = shared <= begin <= end <= len(output) and self.original(output[begin:end]) == text
        base = 0 if self.first else shared  # what a template writes before all turns goes with the first
        found = output[base:], shared - base, *((begin - base, end - base) if readable else (None, None)), readable, rewritten
        self.turns, self.output, self.first = [*self.turns, (role, text)], output, False
        return found


def _formatter(render, restart, original, loss_roles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, conversation, nth = object(), None, 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != current:
                    current, conversation, nth = conv_id, Incremental(render, restart, original), 0
                formatted, start, begin, end, readable, rewritten = conversation.add(role, text)
                in_loss = role in loss_roles and readable and rewritten is None
                rows.append((conv_id, nth, role, formatted, start, begin, end, in_loss, rewritten))
                nth += 1
            yield _batch(rows, FORMATTED)

    return run


def _batch(rows: list[tuple], columns: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(columns.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def format_conversations(
    conversations: DataFrame,
    render: Callable[[Turns], str] = marked_turns,
    original: Callable[[str], str] = unescape,
    loss_roles: tuple[str, ...] = LOSS_ROLES,
    restart: int | None = None,
) -> DataFrame:
    """A row for each turn, conversations together and their turns in order.

    ``formatted`` is what the turn added to the conversation's text (all of them joined are that text), ``start`` where the
    turn begins in it, ``text_start`` and ``text_end`` where its text stands, null if it cannot be read back by
    ``original``; ``in_loss`` marks texts to train on; ``rewritten_at`` is null unless the turn changed earlier output.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatter(render, restart, original, loss_roles), _schema(FORMATTED))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation, from nothing but its formatted text and its mask."""
    current, begun, n_turns, loss_chars, chars, rewritten = None, False, 0, 0, 0, False
    turns = loss = hashlib.sha256()

    def row():
        return current, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewritten

    for batch in batches:
        rows = []
        read = (batch.column(c).to_pylist() for c in ("conv_id", "formatted", "text_start", "text_end", "in_loss", "rewritten_at"))
        for conv_id, formatted, begin, end, in_loss, changed in zip(*read):
            if not begun or conv_id != current:
                if begun:
                    rows.append(row())
                current, begun, n_turns, loss_chars, chars, rewritten = conv_id, True, 0, 0, 0, False
                turns, loss = hashlib.sha256(), hashlib.sha256()
            for role, text in read_back(formatted):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            if in_loss:
                text = unescape(formatted[begin:end])
                loss_chars += len(text)
                loss.update(text.encode())
            chars += len(formatted)
            rewritten = rewritten or changed is not None
        yield _batch(rows, DIGESTS)
    if begun:
        yield _batch([row()], DIGESTS)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from the rows of ``format_conversations`` where they lie.

    For the template of the query. The rows must come as that function gives them: no shuffle in between.
    """
    return formatted.mapInArrow(_digests, _schema(DIGESTS))
