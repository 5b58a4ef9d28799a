"""Chat formatting in budgeted windows.

A conversation's turns, in order, each take so many tokens.  Prefix sums of
these choose windows of whole turns: a window starts where the last one ended,
takes as many new turns as fit the budget next to the system turn and the
history it repeats, and one at least.  The system turn (the first turn, if its
role is system) stands at the head of every window; the history is the latest turns before
the window that fit HISTORY tokens.  Assistant turns are targets: each is
under the loss mask in the one window where it is new, and masked where it is
repeated.

A window is a formatted string and a list of target spans.  Turns are marked by
control strings; in texts and roles an ``<|`` that could begin one gets a
backslash, and so does a backslash before ``|`` after ``<``, so that the texts
come back whatever they hold.

The turns of a conversation are brought together and sorted by one exchange,
and a task walks through them with one window in memory, so a conversation of
any length is handled.  Token counts are those of words and marks, times the
parameter's scale; any function of a text may be given.

Defined results: a null text or role is empty.  Turns with equal numbers are
ordered by role and text; a null turn number comes first.  Rows without conv_id are one
conversation, which has no id; other ids keep every digit.  Repeated rows are turns like any other; a turn of
any length makes a window of its own.  An empty table gives no rows.  Only conv_id, turn, role and text are read,
whatever other columns are called.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common

BUDGET, HISTORY = 512, 128
MARK_TOKENS = 4
START, END = "<|im_start|>", "<|im_end|>"
_PIECE = re.compile(r"\w+|[^\w\s]")
#: "<", any number of backslashes, "|": one backslash more.
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")


def n_tokens(text: str) -> int:
    return sum(1 for _ in _PIECE.finditer(text))


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role ends at the first newline, so its own are written as a backslash and n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Turn:
    role: str
    text: str
    tokens: int


@dataclass
class Window:
    """Text in the template, target spans in it, and for each turn in it whether it is new."""

    text: str = ""
    loss: list[tuple[int, int]] = field(default_factory=list)
    new: list[bool] = field(default_factory=list)


def formatted(system: Turn | None, history: list[Turn], new: list[Turn], system_is_new: bool) -> Window:
    parts, w, at = [], Window(), 0
    turns = ([(system, system_is_new)] if system else []) + [(t, False) for t in history] + [(t, True) for t in new]
    for t, is_new in turns:
        head = f"{START}{escape_role(t.role)}\n"
        body = escape(t.text)
        if is_new and t.role == "assistant":
            w.loss.append((at + len(head), at + len(head) + len(body)))
        parts.append(f"{head}{body}{END}\n")
        at += len(parts[-1])
        w.new.append(is_new)
    w.text = "".join(parts)
    return w


def windows(turns: Iterator[Turn], budget: int = BUDGET, history: int = HISTORY) -> Iterator[Window]:
    """Windows of one conversation; only the open window and its history are held."""
    system: Turn | None = None
    past: list[Turn] = []
    new: list[Turn] = []
    used, first, number = 0, True, 0
    room = budget
    for t in turns:
        number += 1
        if number == 1 and t.role == "system":
            system = t
            room = budget - t.tokens
            continue
        if new and used + t.tokens > room - sum(x.tokens for x in past):
            yield formatted(system, past, new, first)
            first = False
            past = tail([*past, *new], min(history, max(0, room - t.tokens)))
            new, used = [], 0
        elif not new:
            past = tail(past, max(0, room - t.tokens))
        new.append(t)
        used += t.tokens
    if new or (system and first):
        yield formatted(system, past, new, first)


def tail(turns: list[Turn], most: int) -> list[Turn]:
    """The latest turns that take at most so many tokens together."""
    total, k = 0, len(turns)
    while k and total + turns[k - 1].tokens <= most:
        k -= 1
        total += turns[k].tokens
    return turns[k:]


_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a window."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError("no turn starts here")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _ordered(conversations: DataFrame) -> DataFrame:
    c = common.pick(conversations, "conv_id", "turn", "role", "text")
    c = c.select("conv_id", "turn", *[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text")])
    return c.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows as tuples; ids stay the integers they are, null or not."""
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            some = b.slice(lo, 512)
            yield from zip(*[some.column(n).to_pylist() for n in names], strict=True)


def _ids(kind: str):
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind)


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[str], int] = n_tokens) -> DataFrame:
    """conv_id, window, text, loss (spans in text) and new (per turn in it) of every window."""
    kind = conversations.schema[common.place(conversations, "conv_id")].dataType.simpleString()
    spans = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    types = [_ids(kind), pa.int32(), pa.string(), spans, pa.list_(pa.bool_())]
    names = ["conv_id", "window", "text", "loss", "new"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        out: list[tuple] = []
        size = 0
        for conv, rows in groupby(_runs(batches, ["conv_id", "role", "text"]), key=lambda r: r[0]):
            turns = (Turn(role, text, tokens(text) + MARK_TOKENS) for _, role, text in rows)
            for k, w in enumerate(windows(turns, budget, history)):
                out.append((conv, k, w.text, [{"a": a, "b": b} for a, b in w.loss], w.new))
                size += len(w.text)
                if size > 1 << 22:
                    yield _batch(out, names, types)
                    out, size = [], 0
        if out:
            yield _batch(out, names, types)

    return _ordered(conversations).mapInArrow(run, f"conv_id {kind}, window int, text string, loss array<struct<a:long,b:long>>, new array<boolean>")


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def digests(formatted_windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them: n_turns,
    turns_sha256 (role, newline, text, newline per new turn), loss_chars and
    loss_sha256 of all text under the loss mask, and formatted_chars."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = formatted_windows.schema["conv_id"].dataType.simpleString()
    types = [_ids(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        out = []
        for conv, rows in groupby(_runs(batches, ["conv_id", "text", "loss", "new"]), key=lambda r: r[0]):
            n = loss_chars = chars = 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for _, text, spans, new in rows:
                chars += len(text)
                for (role, body), is_new in zip(read_back(text), new, strict=True):
                    if is_new:
                        n += 1
                        turns.update(f"{role}\n{body}\n".encode())
                for s in spans:
                    body = unescape(text[s["a"] : s["b"]])
                    loss_chars += len(body)
                    loss.update(body.encode())
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 5000:
                yield _batch(out, names, types)
                out = []
        if out:
            yield _batch(out, names, types)

    w = formatted_windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return w.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
