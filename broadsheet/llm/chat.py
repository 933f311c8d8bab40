"""Chat formatting in budgeted, turn-aligned windows with a loss mask.

The turns of a conversation are formatted with a template and cut into windows.
Prefix sums of the turns' tokens choose the spans: a window takes as many whole
turns as the budget holds after its system turn and repeated history (one turn
that alone is larger still gets a window). The system turn that opens a
conversation is retained in every window, followed by the last turns before the
span, as many as the history budget holds. Repeated turns are context: they are
masked, so each assistant text is a target exactly once.

    <|im_start|>role
    text<|im_end|>

Inside roles and texts a control string ``<|`` gets a backslash after ``<`` (one
more where there are some already), and a role's line breaks and backslashes are
escaped, so reading a window back gives the turns exactly.

A conversation is streamed through its task in order of turns; only the present
window and its history are held, whatever the conversation's length.

Defined cases: a null text or role is empty; a null turn number comes first; turns
with one number are ordered by role, then text; rows repeated in full are
repeated turns; a null conversation id is one conversation; an empty table gives
an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import tune

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Budget:
    """Sizes in tokens: UTF-8 bytes over four, rounded up, and a few for the template."""

    window: int = 512
    history: int = 128
    per_turn: int = 6


def tokens(text: str, budget: Budget) -> int:
    return -(-len(text.encode()) // 4) + budget.per_turn


# ---- template -----------------------------------------------------------------------


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and tail of a formatted turn; the body may be a target."""
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Turns ``role, text, start, end`` of a formatted window; start and end bound the body."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError("not a formatted window")
        line = text.index("\n", at)
        stop = text.index(END, line)
        out.append((unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : stop]), line + 1, stop))
        at = stop + len(END) + 1
    return out


# ---- windows ----------------------------------------------------------------------------


@dataclass
class Conversation:
    """Turns of one conversation that are not in a closed window yet, and what windows repeat."""

    key: int | None
    budget: Budget
    number: int = 0
    seen: int = 0
    system: tuple[str, str] | None = None
    history: list[tuple[str, str]] = field(default_factory=list)
    pending: list[tuple[str, str]] = field(default_factory=list)
    prefix: list[int] = field(default_factory=lambda: [0])  # sums of the pending turns' tokens

    def _base(self) -> int:
        repeated = ([self.system] if self.system and self.number else []) + self.history
        return sum(tokens(t, self.budget) for _, t in repeated)

    def add(self, role: str, text: str) -> Iterator[tuple]:
        size = tokens(text, self.budget)
        if self.pending and self._base() + self.prefix[-1] + size > self.budget.window:
            yield self.close()
        turn = (role, text)
        if not self.seen and role == "system":
            self.system = turn
        self.seen += 1
        self.pending.append(turn)
        self.prefix.append(self.prefix[-1] + size)

    def close(self) -> tuple:
        """The window of the pending turns: ``conv_id, window, text, n_repeated, targets``."""
        repeated = ([self.system] if self.system and self.number else []) + self.history
        parts, targets, at = [], [], 0
        for k, (role, text) in enumerate([*repeated, *self.pending]):
            head, body, tail = turn_text(role, text)
            if role == "assistant" and k >= len(repeated):
                targets.append({"start": at + len(head), "end": at + len(head) + len(body)})
            parts += [head, body, tail]
            at += len(head) + len(body) + len(tail)
        row = (self.key, self.number, "".join(parts), len(repeated), targets)
        past = [*self.history, *self.pending]
        if past and past[0] is self.system:
            past = past[1:]
        left, keep = self.budget.history, 0
        for _, text in reversed(past):
            left -= tokens(text, self.budget)
            if left < 0:
                break
            keep += 1
        self.history = past[len(past) - keep :]
        self.number, self.pending, self.prefix = self.number + 1, [], [0]
        return row


_WINDOWS = pa.schema(
    [
        ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("n_repeated", pa.int64()),
        ("targets", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
WINDOWS = "conv_id long, window long, text string, n_repeated long, targets array<struct<start:long,end:long>>"


def _rows(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    by_column = list(zip(*columns, strict=True)) if columns else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(by_column, schema, strict=True)], schema=schema)


def _format(budget: Budget):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            out = []
            for key, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is None or now.key != key:
                    if now is not None and now.pending:
                        out.append(now.close())
                    now = Conversation(key, budget)
                out += now.add(role, text)
            yield _rows(out, _WINDOWS)
        if now is not None and now.pending:
            yield _rows([now.close()], _WINDOWS)

    return run


def format_windows(
    turns: DataFrame, budget: Budget = Budget(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Formatted windows with their targets (spans of code points that carry loss)."""
    tune(turns.sparkSession)
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format(budget), WINDOWS)


# ---- reading back ------------------------------------------------------------------------

_READ = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64()),
    ]
)


class _Digest:
    def __init__(self, key):
        self.key, self.turns, self.loss = key, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.windows = 0

    def take(self, text: str, n_repeated: int, targets: list[dict]) -> None:
        for role, body, _, _ in parse(text)[n_repeated:]:
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n_turns += 1
        for t in targets:
            target = unescape(text[t["start"] : t["end"]])
            self.loss.update(target.encode())
            self.loss_chars += len(target)
        self.chars += len(text)
        self.windows += 1

    def row(self) -> tuple:
        return (
            self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.windows
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for b in batches:
        out = []
        for key, text, n_repeated, targets in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.key != key:
                if now is not None:
                    out.append(now.row())
                now = _Digest(key)
            now.take(text, n_repeated, targets)
        yield _rows(out, _READ)
    if now is not None:
        yield _rows([now.row()], _READ)


def read_back(windows: DataFrame) -> DataFrame:
    """Counts and digests per conversation, from the formatted windows alone."""
    dealt = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return dealt.select("conv_id", "text", "n_repeated", "targets").mapInArrow(
        _read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_windows long",
    )
