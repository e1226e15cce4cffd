"""Shortest-pack-first packing over the length histogram.

Documents longer than a sequence fill whole sequences; what remains of each is one
number in a histogram of at most ``limit`` lengths.  The plan is made on that
histogram alone: lengths are placed longest first, each time into the pattern (packs
of one filling, with their count) that has the most room; a new pack is opened
where no open one has room.

There are as many packs as the tokens fill, and no more: for t tokens, t // limit
packs of ``limit`` and one of each power of two in the rest.  When none is left to open,
a length too long for every open pack is cut: its first part fills the shortest pack,
the rest goes back into the histogram under its own, smaller length.  So all packs end
full and nothing is padded (a sequence whose length is a power of two needs none).

Documents find their places by rank: the remainders of one length are numbered within
(task, length) when they are written, a running sum over those counts makes that a
number within the length, and the plan says for each length where ranks lie.  The
remainders of a frequent length are never brought together.

Defined results: null text is empty and gives the end token alone; repeated rows are
packed each for itself; null ids are carried; an empty table gives an empty table;
other columns are left out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import id_and_text, short_batches
from tidewater.llm.pattern_packing import tokenizer
from tidewater.session import materialize

MADE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, place long, ids binary"
OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_KINDS = (pa.int64(),) * 7 + (pa.binary(),)     # of MADE


def remainders(df: DataFrame, token_files: tuple, end: int, limit: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """Whole sequences of long documents, and each document's remainder with its ids (it may be cut
    later); with the task that made them and their number within (task, length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, task = tokenizer(*token_files), TaskContext.get().partitionId()
        seen = [0] * (limit + 1)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tok.ids(text), np.uint32(end)).astype("<u4")
                for s in range(0, len(ids), limit):
                    own = ids[s:s + limit].tobytes()
                    n = len(own) // 4
                    rows.append((doc, s, n, zlib.crc32(own), len(ids), task, seen[n], own if n < limit or with_ids else None))
                    seen[n] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], [x.split()[0] for x in MADE.split(", ")])
    short_batches(df.sparkSession)
    return id_and_text(df, id_col, text_col).mapInArrow(run, MADE)


# ---------------------------------------------------------------- plan (driver; size bounded by the limit)
def plan(hist: np.ndarray, limit: int) -> list[tuple[int, ...]]:
    """Placements (length, at, rank, n, size, pack, offset, many): of the remainders of ``length``, those ranked
    ``rank`` to ``rank + n - 1`` put the ``size`` tokens behind their first ``at`` into pack
    ``pack + i // many``, at ``offset + i % many * size``."""
    tokens = int(sum(n * int(c) for n, c in enumerate(hist)))
    unopened, opened = tokens // limit, 0
    packs: list[tuple[int, int, int, int]] = []         # (-room, first pack, packs, capacity): most room first
    for bit in range((tokens % limit).bit_length()):
        if tokens % limit >> bit & 1:
            packs.append((-(1 << bit), unopened + len(packs), 1, 1 << bit))
    heapq.heapify(packs)
    todo: list[list[tuple[int, int, int, int]]] = [[] for _ in range(limit + 1)]   # by length: (whole length, at, rank, n)
    for n in range(1, limit + 1):
        if hist[n]:
            todo[n].append((n, 0, 0, int(hist[n])))
    out = []
    for size in range(limit, 0, -1):
        while todo[size]:
            whole, at, rank, n = todo[size].pop()
            room, pack, count, full = packs[0] if packs else (0, 0, 0, 0)
            room = -room
            if room >= size:
                heapq.heappop(packs)
                # copies that go here before another pattern has more room
                after = -packs[0][0] if packs else 0
                many = max(1, min(-((after - room) // size), room // size, n // count))
                used = min(count, n)
                out.append((whole, at, rank, used * many, size, pack, full - room, many))
                if room > size * many:
                    heapq.heappush(packs, (size * many - room, pack, used, full))
                if count > used:
                    heapq.heappush(packs, (-room, pack + used, count - used, full))
                placed = used * many
            elif unopened:
                placed = min(n, unopened)
                out.append((whole, at, rank, placed, size, opened, 0, 1))
                if size < limit:
                    heapq.heappush(packs, (size - limit, opened, placed, limit))
                unopened, opened = unopened - placed, opened + placed
            else:
                heapq.heappop(packs)
                placed = min(n, count)
                out.append((whole, at, rank, placed, room, pack, full - room, 1))
                todo[size - room].append((whole, at + room, rank, placed))
                if count > placed:
                    heapq.heappush(packs, (-room, pack + placed, count - placed, full))
            if n > placed:
                todo[size].append((whole, at, rank + placed, n - placed))
    return out


class Places:
    """The plan as arrays: for a length, a rank and a number of tokens placed already, the next piece."""

    def __init__(self, planned: list[tuple[int, ...]], limit: int):
        t = np.array(sorted(planned), np.int64).reshape(-1, 8)
        self.limit = limit
        group = t[:, 0] * (limit + 1) + t[:, 1]
        self.groups = np.unique(group)
        # ranks of a group need not begin at 0, nor adjoin: they are found by group and rank
        self.key = np.searchsorted(self.groups, group) << 40 | t[:, 2]
        self.rank, self.size, self.pack, self.offset, self.many = (t[:, i] for i in (2, 4, 5, 6, 7))

    def find(self, length: np.ndarray, rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Size, sequence and offset of the pieces."""
        group = np.searchsorted(self.groups, length * (self.limit + 1) + at)
        i = np.searchsorted(self.key, group << 40 | rank, side="right") - 1
        within = rank - self.rank[i]
        return self.size[i], self.pack[i] + within // self.many[i], self.offset[i] + within % self.many[i] * self.size[i]


def pack(df: DataFrame, token_files: tuple, end: int, limit: int, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there; ``with_ids`` adds its ids as little-endian
    32-bit numbers."""
    spark = df.sparkSession
    made = materialize(remainders(df, token_files, end, limit, id_col, text_col, with_ids), "remainders")
    counts = materialize(made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "remainder-counts")
    hist = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():     # at most ``limit`` rows
        hist[r["length"]] = r["n"]
    places = spark.sparkContext.broadcast(Places(plan(hist, limit), limit))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = made.join(shift, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("place") + F.col("shift")).alias("rank"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in OUT.split(", ")]
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            row, at = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
            while len(row):                     # the first piece of each, then the second of those that were cut
                size, seq, off = places.value.find(length[row], rank[row], at)
                part = b.take(pa.array(row))
                crc, ids = part.column(3).to_pylist(), part.column(6)
                own: list = [None] * len(row)
                cut = size < length[row]
                for i in range(len(row)) if with_ids else np.flatnonzero(cut):
                    own[i] = ids[i].as_py()[4 * at[i]:4 * (at[i] + size[i])]
                    crc[i] = zlib.crc32(own[i])
                cols = [part.column(0), pa.array(part.column(1).to_numpy() + at), pa.array(size), pa.array(crc, pa.int64()),
                        part.column(4), pa.array(seq), pa.array(off)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(own, pa.binary())] * with_ids, names + ["ids"] * with_ids)
                at = at + size
                left = at < length[row]
                row, at = row[left], at[left]
    short_batches(spark)
    return ranked.mapInArrow(run, OUT + (", ids binary" if with_ids else ""))
