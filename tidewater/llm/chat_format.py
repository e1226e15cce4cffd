"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says, for each role, how a turn opens and closes and whether its
text takes part in the loss; the machine says which role may follow which.
Formatting emits segments (text, loss flag); joined, they are the formatted
conversation.  Control strings inside texts are escaped with a backslash, so the
output can be read back exactly.

Rows of a conversation meet in one partition, sorted by turn (Spark's external
sort), and are streamed: a worker holds one turn at a time and running digests,
never a conversation.  A digest of a whole conversation is sequential by nature;
conversations, not turns, are what is spread over tasks.

Defined results: null text and null role read as empty; a null conversation id
is a conversation of its own; a null turn comes first; rows of equal turn are
ordered by role and text, repeated rows stay; an invalid turn order is formatted
all the same and marked ``valid = false``; unknown roles are written with their
escaped name; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, short_batches

ESCAPE = "\\"


class OpenTurn(ValueError):
    """Formatted text that ends inside a turn."""


@dataclass(frozen=True)
class Template:
    """Turn markers, loss flags and the role machine, as data."""
    opens: dict = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: ", "tool": "### Tool: "})
    other: tuple = ("### Role ", ": ")            # around the name of a role that has no marker
    close: str = "</turn>\n"
    loss: tuple = ("assistant",)
    #: state -> roles that may come next; a conversation may end in a state of ``ends``
    machine: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant", "tool")})
    ends: tuple = ("user", "assistant")

    def control(self) -> re.Pattern:
        """What has to be escaped inside a text: the escape itself, any opening and the closing marker."""
        marks = sorted({*self.opens.values(), self.other[0], self.close.rstrip("\n")}, key=len, reverse=True)
        return re.compile("|".join([re.escape(ESCAPE), *map(re.escape, marks)]))

    def escape(self, text: str) -> str:
        return self.control().sub(lambda m: ESCAPE + m[0], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss flag) of one turn; only the turn's own text can carry the flag."""
        if role in self.opens:
            opening = self.opens[role]
        else:       # a role's name must not hold the string that ends it
            opening = self.other[0] + self.escape(role).replace(self.other[1], ESCAPE + self.other[1]) + self.other[1]
        return [(opening, False), (self.escape(text), role in self.loss), (self.close, False)]

    def step(self, state: str | None, role: str) -> str | None:
        """Next state; None once the order is broken."""
        return role if state is not None and role in self.machine.get(state, ()) else None

    def read_turn(self, formatted: str, at: int = 0) -> tuple[str, str, int]:
        """Role, text and end of the turn that starts at ``at``: the inverse of :meth:`segments`."""
        role, body = None, at
        for name, opening in self.opens.items():
            if formatted.startswith(opening, at):
                role, body = name, at + len(opening)
                break
        if role is None:
            if not formatted.startswith(self.other[0], at):
                raise ValueError(f"no turn starts at {at}")
            role, body = _until(formatted, at + len(self.other[0]), self.other[1])
        text, end = _until(formatted, body, self.close)
        return role, text, end


def _until(s: str, at: int, stop: str) -> tuple[str, int]:
    """Unescaped text from ``at`` to the first ``stop`` that is not escaped, and the place behind it."""
    out = []
    for m in re.compile(rf"{re.escape(ESCAPE)}([\s\S])|{re.escape(stop)}").finditer(s, at):
        out.append(s[at:m.start()])
        if m[1] is None:
            return "".join(out), m.end()
        out.append(m[1])
        at = m.end()
    raise OpenTurn("a turn does not end")


def read_back(formatted: str, template: Template) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        role, text, at = template.read_turn(formatted, at)
        out.append((role, text))
    return out


def _sorted(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = df.select(col(conv_col).cast("long").alias("conv_id"), col(turn_col).cast("long").alias("turn"),
                     F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    short_batches(df.sparkSession)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def segments(df: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted segments of all conversations: conv_id, place (from 0), text, loss."""
    t = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, place = object(), 0
        for b in batches:
            rows = []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != own:
                    own, place = conv, 0
                for s, flag in t.segments(role, text):
                    rows.append((conv, place, s, flag))
                    place += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.bool_()))], ["conv_id", "place", "text", "loss"])
    return _sorted(df, conv_col, turn_col, role_col, text_col).mapInArrow(run, "conv_id long, place long, text string, loss boolean")


class _Digest:
    """Running figures of one conversation, read back from its formatted text.

    Segments are joined as they come, and the reader takes turns off the front: where one ends the next must begin, whatever
    the segments say.  A turn that does not end yet waits for more text."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars, self.state = conv, 0, 0, 0, ""
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.unread = ""

    def add(self, t: Template, role: str, text: str) -> None:
        for s, flag in t.segments(role, text):
            self.chars += len(s)
            self.unread += s
            if flag:
                plain = _until(s + t.close, 0, t.close)[0]
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())
        self._read(t)

    def _read(self, t: Template) -> None:
        at = 0
        while at < len(self.unread):
            try:
                role, text, at = t.read_turn(self.unread, at)
            except OpenTurn:
                break
            self.turns += 1
            self.state = t.step(self.state, role)
            self.all.update(f"{role}\n{text}\n".encode())
        self.unread = self.unread[at:]

    def row(self, t: Template):
        if self.unread:
            raise OpenTurn(f"the formatted conversation {self.conv} does not end with a turn")
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.state in t.ends


NAMES = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid")
KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())


def digests(df: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation, read back from its formatted text as it is joined."""
    t = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), KINDS)], list(NAMES))
        for b in batches:
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if now is None or conv != now.conv:
                    if now:
                        done.append(now.row(t))
                    now = _Digest(conv)
                now.add(t, role, text)
            if len(done) >= 1000:
                yield flush()
                done = []
        if now:
            done.append(now.row(t))
        if done:
            yield flush()
    return _sorted(df, conv_col, turn_col, role_col, text_col).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")
