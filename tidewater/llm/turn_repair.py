"""Conversation structure repair by Four-Russians block tables.

The turns of a conversation are kept, given another role, deleted, or new ones are
inserted, at least cost, so that the roles read ``(s?(ua)+)?`` by their initials: an
optional system turn, then user and assistant in turns.  Costs are data (:class:`Costs`).

A turn is one of nine symbols: its initial (s, u, a, other), whole or truncated, or
"must go".  The state of the grammar has four values, so what is left to pay behind a
turn is a vector of four costs.  Less its minimum, such a vector is one of a few dozen,
whatever follows.  For each of these and each block of ``BLOCK`` symbols a table
holds the vector before the block and the cost that the block adds; a
conversation is processed from its end, a lookup for each block.  The edits are then
traced from its beginning: a block is expanded symbol by symbol, backward from the
vector behind it, and of the edits that keep the cost the one whose letter is least in ASCII is
taken, so ties are resolved for the whole conversation and not only inside a block.

Turns are numbered by a range partition of all rows (a long conversation is many tasks'
work), first occurrences by an aggregation that combines map-side; the tables see one character
for each turn, in segments of ``SEGMENT`` turns.  Only the edits as one string and the digest of the repaired
text are sequential by nature: they stream a conversation's rows, in order, through one task that holds
one turn and the string of edits.

Defined results: a null text or role is one space; a null turn comes first; rows of equal turn
are ordered by role and text; repeated rows are duplicates; a null conversation id is a
conversation of its own; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, short_batches
from tidewater.operators.relational import rank_within
from tidewater.session import materialize

SEGMENT = 8192          # turns whose symbols travel as one string
BLOCK = 4               # symbols looked up at once
START, SYSTEM, USER, ASSISTANT = range(4)
#: where a user or assistant turn leads to, by state: the one that the grammar needs next
NEXT = (USER, USER, ASSISTANT, USER)
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: symbols of the tables: initials of whole turns, of truncated ones, one that must go, and the filling of a short block
SYMBOLS = (*((i, False) for i in "suao"), *((i, True) for i in "suao"), None, "fill")
GONE, FILL = 8, 9
FAULTS = ("none", "blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Costs:
    """What each edit costs; ``truncated`` is added for a truncated turn that is not deleted."""
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3

    def __post_init__(self):
        if min(getattr(self, f.name) for f in fields(self)) < 0 or not self.insert:
            raise ValueError("costs must not be negative, and an insertion must cost something")


class Tables:
    """Transitions of normalised cost vectors, for single symbols and for blocks."""

    def __init__(self, costs: Costs):
        self.costs = costs
        end = self._with_inserts([0, None, None, 0])
        self.vectors, self.step = [end], []     # step[vector][symbol]: (vector before, cost added)
        known = {end: 0}
        while len(self.step) < len(self.vectors):
            behind, row = self.vectors[len(self.step)], []
            for symbol in range(len(SYMBOLS)):
                before = self.before(symbol, behind)
                least = min(before)
                before = tuple(x - least for x in before)
                if before not in known:
                    known[before] = len(self.vectors)
                    self.vectors.append(before)
                row.append((known[before], least))
            self.step.append(row)
        one = np.array(self.step, np.int64)     # (vector, symbol, 2)
        vector, cost = one[:, :, 0], one[:, :, 1]
        for _ in range(BLOCK - 1):              # one more symbol on the left
            cost = (cost[:, None, :] + one[:, :, 1][vector].transpose(0, 2, 1)).reshape(len(one), -1)
            vector = one[:, :, 0][vector].transpose(0, 2, 1).reshape(len(one), -1)
        self.vector, self.cost = vector.tolist(), cost.tolist()
        self._expanded: dict = {}

    def _with_inserts(self, direct: list) -> tuple[int, ...]:
        """Costs when turns may be inserted first (two always lead round the grammar)."""
        best = [float("inf") if x is None else x for x in direct]
        for _ in range(len(NEXT)):
            best = [min(x, self.costs.insert + best[NEXT[q]]) for q, x in enumerate(best)]
        return tuple(best)

    def edits(self, symbol: int, q: int) -> list[tuple[str, int, int]]:
        """(letter, cost, state behind) of what can be done to a turn in state ``q``, in ASCII order."""
        out = [("D", self.costs.delete, q)]
        if symbol != GONE:
            initial, cut = SYMBOLS[symbol]
            more = self.costs.truncated if cut else 0
            if (q, initial) in KEEPS:
                out.append(("K", more, KEEPS[q, initial]))
            out.append(("R", self.costs.rerole + more, NEXT[q]))
        return out

    def before(self, symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
        """Costs before a turn, from those behind it."""
        if symbol == FILL:
            return behind
        return self._with_inserts([min(c + behind[to] for _, c, to in self.edits(symbol, q)) for q in range(4)])

    def _trace(self, symbol: int, behind: tuple[int, ...], q: int) -> tuple[str, int]:
        """Letters up to and with the edit of one turn, and the state behind it."""
        here, letters = self.before(symbol, behind), ""
        while True:
            options = [(letter, c, to) for letter, c, to in self.edits(symbol, q) if c + behind[to] == here[q]]
            inserts = self.costs.insert + here[NEXT[q]] == here[q]
            if options and (not inserts or options[0][0] < "I"):
                return letters + options[0][0], options[0][2]
            letters, q = letters + "I", NEXT[q]

    def expand(self, code: int, behind: int, q: int) -> tuple[str, int]:
        """Letters of a block in front of the vector ``behind``, entered in state ``q``, and the state after it."""
        key = code, behind, q
        if key not in self._expanded:
            symbols, vectors = [int(x) for x in f"{code:0{BLOCK}d}"], [behind]
            for symbol in reversed(symbols):
                vectors.append(self.step[vectors[-1]][symbol][0])
            letters = ""
            for symbol, v in zip(symbols, reversed(vectors[:-1])):
                if symbol != FILL:
                    more, q = self._trace(symbol, self.vectors[v], q)
                    letters += more
            self._expanded[key] = letters, q
        return self._expanded[key]

    def repair(self, symbols: str) -> tuple[int, str]:
        """Least cost, and the least of the edit strings that have it."""
        symbols = str(FILL) * (-len(symbols) % BLOCK) + symbols
        codes = [int(symbols[i:i + BLOCK]) for i in range(0, len(symbols), BLOCK)]
        cost, behind, v = 0, [], 0
        for code in reversed(codes):
            behind.append(v)
            cost += self.cost[v][code]
            v = self.vector[v][code]
        cost += self.vectors[v][START]
        out, q = [], START
        for code, v in zip(codes, reversed(behind)):
            letters, q = self.expand(code, v, q)
            out.append(letters)
        while q not in (START, ASSISTANT):
            out.append("I")
            q = NEXT[q]
        return cost, "".join(out)


@lru_cache(maxsize=4)
def tables(costs: Costs) -> Tables:
    return Tables(costs)


# ---------------------------------------------------------------- turns
def turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with one space for nulls."""
    return df.select(col(conv_col).cast("long").alias("conv_id"), col(turn_col).cast("long").alias("turn"),
                     F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"))


def numbered(rows: DataFrame) -> DataFrame:
    """The turns with their place (from 1) in their conversation.  Equal rows may stand in any order, so a
    number of their own spreads them over tasks."""
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    return rank_within(salted, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text", "salt"], "place").drop("salt")


def _segments(placed: DataFrame) -> DataFrame:
    """``conv_id, segment, marks``: a letter for each turn, of its initial and its fault."""
    seen = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("first"))
    seen = seen.select(F.col("conv_id").alias("_conv"), "first")
    initial = F.substring("role", 1, 1)
    trimmed = F.rtrim("text", F.lit(SPACES))
    light = placed.select("conv_id", "place", (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
                          F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"))
    # each first occurrence is met by its own place, so a text said very often is no hot key
    both = light.join(seen, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("first")), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    mark = F.char(F.lit(65) + F.col("initial") * len(FAULTS) + fault)
    ordered = F.array_sort(F.collect_list(F.struct("place", mark.alias("mark"))))
    return (both.groupBy("conv_id", F.floor((F.col("place") - 1) / SEGMENT).alias("segment"))
            .agg(F.array_join(F.transform(ordered, lambda x: x["mark"]), "").alias("marks")))


_MARKS = "".join(chr(65 + i) for i in range(4 * len(FAULTS)))
_SYMBOL = str.maketrans(_MARKS, "".join(str((i // 4, GONE, GONE, 4 + i // 4)[i % 4]) for i in range(len(_MARKS))))
_INITIAL = str.maketrans(_MARKS, "".join("suao"[i // 4] for i in range(len(_MARKS))))
AUDIT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(segments: DataFrame, costs: Costs) -> DataFrame:
    """One row for each conversation that has turns: its faults, the least cost, the edits."""
    def answer(conv, marks: str) -> tuple:
        initials = marks.translate(_INITIAL)
        pairs = max(len(marks) - 1, 0) - sum(initials.count(p) for p in LEGAL)
        faults = [sum(marks.count(_MARKS[i + k]) for i in range(0, len(_MARKS), len(FAULTS))) for k in (1, 2, 3)]
        return conv, *faults, pairs, *tables(costs).repair(marks.translate(_SYMBOL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in AUDIT.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()]
        own, parts, done = object(), [], []
        for b in batches:
            for conv, marks in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if conv != own:
                    if parts:
                        done.append(answer(own, "".join(parts)))
                    own, parts = conv, []
                parts.append(marks)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
                done = []
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*[answer(own, "".join(parts))]), kinds)], names)
    short_batches(segments.sparkSession)
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInArrow(run, AUDIT)


def apply(audit: str, roles: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns, from the edits and the conversation's turns in order."""
    q = START
    for letter in audit:
        if letter == "I":
            q = NEXT[q]
            yield letter, ROLES[q], ""
            continue
        role, text = next(roles)
        if letter == "R":
            q = NEXT[q]
            yield letter, ROLES[q], text
        elif letter == "K":
            q = KEEPS[q, role[0]]
            yield letter, role, text


def _stream(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's edits (place 0), then its turns, in one partition and in order."""
    heads = audits.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = heads.unionByName(placed.select("conv_id", "place", "role", "text"))
    short_batches(placed.sparkSession)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple[str, str, str]]]]:
    """(conversation, its repaired turns) one after the other; the turns are drawn as they come."""
    rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(4))))
    ahead = next(rows, None)

    def own_turns() -> Iterator[tuple[str, str]]:
        nonlocal ahead
        while ahead is not None and ahead[1] > 0:
            row, ahead = ahead, next(rows, None)
            yield row[2], row[3]
    while ahead is not None:
        conv, audit = ahead[0], ahead[3]
        ahead = next(rows, None)
        left = own_turns()
        yield conv, apply(audit, left)
        for _ in left:
            pass


def repaired(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit (K, R or I), role, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def flush():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv_id", "place", "edit", "role", "text"])
        for conv, out in _conversations(batches):
            for place, (letter, role, text) in enumerate(out):
                rows.append((conv, place, letter, role, text))
                if len(rows) == 256:
                    yield flush()
                    rows = []
        if rows:
            yield flush()
    return _stream(placed, audits).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")


def _digests(placed: DataFrame, audits: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation's ``role:text``, joined by newlines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hexes = [], []
        for conv, out in _conversations(batches):
            digest, between = hashlib.sha256(), ""
            for _, role, text in out:
                digest.update(f"{between}{role}:{text}".encode())
                between = "\n"
            ids.append(conv)
            hexes.append(digest.hexdigest())
            if len(ids) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes)], ["conv_id", "repaired_sha256"])
                ids, hexes = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hexes)], ["conv_id", "repaired_sha256"])
    return _stream(placed, audits).mapInArrow(run, "conv_id long, repaired_sha256 string")


def audit(placed: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Faults, cost and edits of each conversation of :func:`numbered` turns."""
    return _audits(_segments(placed), costs)


def report(rows: DataFrame, conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """One row for each id of ``conversations`` (a frame with a ``conv_id`` column), from the
    :func:`turns` that there are: gaps in the turn numbers, faults, cost, edits, digest of the repaired text."""
    placed = numbered(rows)
    gaps = placed.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1).alias("wide")).select(F.col("conv_id").alias("_gap"), "wide")
    known = placed.where(F.col("turn").isNotNull()).groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(F.count("one").alias("n"))
    known = known.select(F.col("conv_id").alias("_known"), "n")
    edits = materialize(audit(placed, costs), "turn-edits")
    digests = _digests(placed, edits.select("conv_id", "audit")).withColumnRenamed("conv_id", "_digest")
    out = conversations.select("conv_id").distinct().select(F.col("conv_id").alias("_all"))
    for side, key in ((edits, "conv_id"), (digests, "_digest"), (gaps, "_gap"), (known, "_known")):
        out = out.join(side, F.col("_all").eqNullSafe(F.col(key)), "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(F.col("_all").alias("conv_id"), F.coalesce(F.col("wide") - F.col("n"), F.lit(0)).cast("long").alias("gaps"),
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
