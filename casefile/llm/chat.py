r"""Chat formatting: successive prefixes of a conversation are rendered, consecutive outputs compared.

The template is a black box from a list of messages to text. The span of a turn is what its prefix adds
to the output before; a template whose longer output does not start with the shorter one rewrites
history, and the turn where that happens is reported. Inside its span a turn's role and text are read
back, and the text of the roles that are trained on gets the loss mask.

Turns reach a task sorted by conversation and turn. A template is rendered over whole prefixes: the work is
quadratic in a conversation's length, and memory holds the conversation. Only for a template whose `__call__`
is declared `turn_by_turn` a prefix starts anew after `window` turns, with the turn before as its context:
the output is the same, the work linear, and memory holds one record batch whatever the length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import map_arrow, record_batch

Message = tuple[str, str]  # role, text


def turn_by_turn(call: Callable) -> Callable:
    """Declares that a template's `__call__` joins what it makes of each message alone. One that overrides it declares anew."""
    call.turn_by_turn = True
    return call


class InstTemplate:
    r"""Turns in brackets: `[INST] text [/INST]` for users, `text </s>` for assistants, `<s>[ROLE name] text [/ROLE]` else.

    A backslash goes before every `\`, `[`, `]`, `<` and `>` inside roles and texts, so no text can hold a
    control string, and taking the backslashes away gives the text again.
    """

    SPECIAL = re.compile(r"([\\\[\]<>])")
    ESCAPED = re.compile(r"\\([\\\[\]<>])")
    SPAN = re.compile(
        r"(?s)\[INST\] (?P<user>.*) \[/INST\]\n|<a>(?P<assistant>.*) </s>\n|<s>\[ROLE (?P<role>.*?(?<!\\)(?:\\\\)*)\] (?P<other>.*) \[/ROLE\]\n"
    )

    def escape(self, text: str) -> str:
        return self.SPECIAL.sub(r"\\\1", text)

    def unescape(self, text: str) -> str:
        return self.ESCAPED.sub(r"\1", text)

    def turn(self, role: str, text: str) -> str:
        text = self.escape(text)
        if role == "user":
            return f"[INST] {text} [/INST]\n"
        if role == "assistant":
            return f"<a>{text} </s>\n"
        return f"<s>[ROLE {self.escape(role)}] {text} [/ROLE]\n"

    @turn_by_turn
    def __call__(self, messages: list[Message]) -> str:
        return "".join(self.turn(role, text) for role, text in messages)

    def read(self, span: str) -> tuple[str, int, int] | None:
        """Role, and where the escaped text stands in the span; None if the span is no turn."""
        found = self.SPAN.fullmatch(span)
        if not found:
            return None
        for kind in ("user", "assistant"):
            if found[kind] is not None:
                return kind, *found.span(kind)
        return self.unescape(found["role"]), *found.span("other")


@dataclass
class Turn:
    """A turn as it was read back. `span` is its piece of the output, `at` its place there; `start`, `end` bound its text in it."""

    span: str
    at: int
    role: str | None
    text: str
    start: int
    end: int
    rewrites: bool


class PrefixRenderer:
    """Feeds one conversation's turns through the template, one at a time."""

    def __init__(self, template, window: int = 64):
        self.template, self.window = template, window
        self.messages: list[Message] = []
        self.output = ""
        self.before = 0  # characters of the output that are no longer held
        self.restarts = getattr(type(template).__call__, "turn_by_turn", False)

    @property
    def length(self) -> int:
        return self.before + len(self.output)

    def add(self, role: str, text: str) -> Turn:
        if self.restarts and len(self.messages) > self.window:
            whole, joined, self.messages = self.length, self.output, self.messages[-1:]
            self.output = self.template(self.messages)
            if not joined.endswith(self.output):
                raise ValueError("the template is declared turn by turn, but a turn's output depends on earlier ones")
            self.before = whole - len(self.output)
        self.messages.append((role, text))
        longer = self.template(self.messages)
        rewrites = not longer.startswith(self.output)
        start = len(_common_prefix(self.output, longer)) if rewrites else len(self.output)
        self.output, span, at = longer, longer[start:], self.before + start
        found = self.template.read(span)
        if found is None:
            return Turn(span, at, None, "", 0, 0, rewrites)
        role, first, last = found
        return Turn(span, at, role, self.template.unescape(span[first:last]), first, last, rewrites)


def _common_prefix(a: str, b: str) -> str:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[:low]


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One shuffle by conversation; ties in the turn are ordered by role and text. Texts of null are empty."""
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _messages(batches) -> Iterator[tuple[object, object, str, str]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns), strict=True)


_TURN_SCHEMA = (
    "conv_id long, turn long, position long, role string, text string, formatted string, span_start long, span_end long, "
    "loss_start long, loss_end long, rewrites_history boolean"
)
_TURNS = [
    ("conv_id", pa.int64()),
    ("turn", pa.int64()),
    ("position", pa.int64()),
    ("role", pa.string()),
    ("text", pa.string()),
    ("formatted", pa.string()),
    *((name, pa.int64()) for name in ("span_start", "span_end", "loss_start", "loss_end")),
    ("rewrites_history", pa.bool_()),
]


def format_turns(
    df: DataFrame,
    template=None,
    conv_col="conv_id",
    turn_col="turn",
    role_col="role",
    text_col="text",
    trained: tuple[str, ...] = ("assistant",),
    window: int = 64,
) -> DataFrame:
    """A row per turn: its span of the conversation's output, what is read back from it, and its loss mask.

    Offsets are code points of the output up to and with the turn, which is the start of the whole conversation's
    output unless a later turn rewrites history; loss_start and loss_end bound the escaped
    text of a trained role and are null for others; a span that the template cannot read back has a null role. Null ids are one conversation; null roles and texts are
    empty; a null turn comes first; repeated rows are turns each; an empty table gives no rows; other
    columns are not read.
    """
    template = template or InstTemplate()

    def run(batches):
        current, rows = object(), []
        for conv, turn, role, text in _messages(batches):
            if conv != current:
                current, renderer, position = conv, PrefixRenderer(template, window), 0
            done = renderer.add(role, text)
            at = done.at
            masked = done.role in trained
            rows.append(
                (conv, turn, position, done.role, done.text, done.span, at, at + len(done.span),
                 at + done.start if masked else None, at + done.end if masked else None, done.rewrites)
            )
            position += 1
            if len(rows) >= 1000:
                yield record_batch(_TURNS, *map(list, zip(*rows, strict=True)))
                rows = []
        if rows:
            yield record_batch(_TURNS, *map(list, zip(*rows, strict=True)))

    return map_arrow(_ordered(df, conv_col, turn_col, role_col, text_col), run, _TURN_SCHEMA)


_DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_rewrites long, unreadable_turns long"
)
_DIGESTS = [
    ("conv_id", pa.int64()),
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
    ("n_rewrites", pa.int64()),
    ("unreadable_turns", pa.int64()),
]


def conversation_digests(
    df: DataFrame,
    template: Callable | None = None,
    conv_col="conv_id",
    turn_col="turn",
    role_col="role",
    text_col="text",
    trained: tuple[str, ...] = ("assistant",),
    window: int = 64,
) -> DataFrame:
    """A row per conversation, from the turns that `format_turns` reads back from the output.

    turns_sha256 is over role, line break, text, line break of every turn; loss_sha256 over the unescaped
    text under the loss mask. A digest is sequential by definition, so a conversation's turns pass through
    one task, as a stream that keeps the digests and what rendering needs. `formatted_chars` is the length of
    the whole output. `unreadable_turns` counts turns whose span the template cannot read back; what such a
    conversation holds is not known, so its digests and loss_chars are null. A template declared turn by turn
    whose turns depend on earlier ones raises. Other edge cases as in `format_turns`.
    """
    template = template or InstTemplate()

    def run(batches):
        current, rows, state = object(), [], None
        for conv, _, role, text in _messages(batches):
            if conv != current:
                if state:
                    rows.append(_finish(current, state))
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, PrefixRenderer(template, window), 0]
            done = state[6].add(role, text)
            state[0] += 1
            state[7] += done.role is None
            state[1].update(f"{done.role}\n{done.text}\n".encode())
            if done.role in trained:
                state[2] += len(done.text)
                state[3].update(done.text.encode())
            state[4] = state[6].length
            state[5] += done.rewrites
            if len(rows) >= 1000:
                yield record_batch(_DIGESTS, *map(list, zip(*rows, strict=True)))
                rows = []
        if state:
            rows.append(_finish(current, state))
        if rows:
            yield record_batch(_DIGESTS, *map(list, zip(*rows, strict=True)))

    return map_arrow(_ordered(df, conv_col, turn_col, role_col, text_col), run, _DIGEST_SCHEMA)


def _finish(conv, state) -> tuple:
    n, turns, chars, loss, formatted, rewrites, _, unreadable = state
    if unreadable:
        return conv, n, None, None, None, formatted, rewrites, unreadable
    return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, rewrites, 0
