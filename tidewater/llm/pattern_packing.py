"""Best-fit packing by length patterns and non-negative least squares.

Only the length histogram of the pieces (at most ``limit`` numbers) decides how
pieces are combined, whatever their number.  Patterns are multisets of one to
three lengths that fill a sequence exactly; non-negative least squares fits how
often each is repeated so that their lengths reproduce the histogram; the counts
are rounded down, and what remains is packed by best-fit decreasing on counts.
The plan is a bounded table.

Pieces are numbered within (task, length) when they are made and written; a
running sum over the counts of (length, task) turns this into a number within
the length, without bringing the pieces of a length together.  The number picks
the piece's slot in the plan.  So a frequent length is never one task's work.

Long documents are cut from the end: full pieces last, the remainder first.

Defined results: null text is empty and gives one piece, the end token alone;
repeated rows are packed each for itself; null ids are carried; an empty table
gives an empty table; other columns are left out.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import id_and_text, map_batches, short_batches
from tidewater.session import materialize

NNLS_STEPS = 400
SHARES = (1.0, 0.9, 0.7, 0.4, 0.0)      # of the fitted counts, tried in turn
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"
# texts of these characters are cut alike by both tokenizer libraries; others take the slower one
_PLAIN = re.compile("[\t\n\r -~À-ɏ]*")


class Tokenizer:
    """Ids of a byte-level BPE file.

    ``ranks`` may name the same vocabulary as tiktoken ranks (with its splitting
    pattern): ordinary texts are then encoded by that faster library, with equal
    ids; texts with special strings or unusual characters go by the file itself.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        self.path, self.fast = path, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", [])]
        if ranks:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    @cached_property
    def slow(self):
        """The file's own tokenizer, loaded when a text first needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        tok = tokenizers.Tokenizer.from_file(self.path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def ids(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def tokenizer(path: str, ranks: str | None, pattern: str | None) -> Tokenizer:
    return Tokenizer(path, ranks, pattern)


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: the remainder first, then full ones."""
    if n <= limit:
        return [(0, n)]
    first = n % limit
    return ([(0, first)] if first else []) + [(s, limit) for s in range(first, n, limit)]


def pieces(df: DataFrame, token_files: tuple, end: int, limit: int, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """All pieces, with the task that made them and their number within (task, length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, task = tokenizer(*token_files), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for b in batches:
            rows, own = [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(tok.ids(text), np.uint32(end)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), limit)):
                    rows.append((doc, k, s, n, zlib.crc32(ids[s:s + n].tobytes()), task, seen[n]))
                    seen[n] += 1
                    if with_ids:
                        own.append(ids[s:s + n])
            if rows:
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
                cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"]
                if with_ids:
                    cols.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)
    short_batches(df.sparkSession)
    return id_and_text(df, id_col, text_col).mapInArrow(run, PIECE_SCHEMA + (", ids array<int>" if with_ids else ""))


# ---------------------------------------------------------------- plan (driver; size bounded by the limit)
def patterns(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Rows of three lengths (0: none) that add up to ``limit`` exactly, from the lengths present."""
    have = np.zeros(limit + 1, bool)
    have[lengths] = True
    out = [[limit, 0, 0]] if have[limit] else []
    low = np.flatnonzero(have[:limit])
    for a in low[low > 0]:
        if a <= limit - a and have[limit - a]:
            out.append([limit - a, a, 0])
    triples = []
    for a in low[low > 0]:              # a <= b <= c
        b = low[(low >= a) & (low <= (limit - a) // 2)]
        c = limit - a - b
        ok = have[c] & (c >= b)
        triples.append(np.column_stack([c[ok], b[ok], np.full(ok.sum(), a)]))
    pairs = np.array(out, np.int64).reshape(-1, 3)
    return np.concatenate([pairs, *triples]) if triples else pairs


def fit_counts(pats: np.ndarray, hist: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ||A x - hist||, by accelerated projected gradient.

    A's column for a pattern holds its lengths' multiplicities; it is never
    formed.  Rows are scaled by 1/sqrt(count), so that rare lengths count too.
    """
    n, size = len(pats), len(hist)
    if not n:
        return np.zeros(0)
    w = 1.0 / np.sqrt(np.maximum(hist, 1.0))
    w[0] = 0.0

    def times(x):
        y = sum(np.bincount(pats[:, j], x, size) for j in range(3))
        return y * w

    def back(r):
        r = r * w
        return r[pats[:, 0]] + r[pats[:, 1]] + r[pats[:, 2]]
    v = np.ones(n)
    for _ in range(30):                 # largest singular value, for the step
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    step, target = 1.0 / (1.05 * norm), hist * w
    x = z = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(z - step * back(times(z) - target), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(hist: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every length exactly as often as ``hist`` says.

    Where long pieces have too few short ones to go with, full patterns would use
    these up on each other; so some shares of the fitted counts are tried, and the
    plan with the fewest sequences is taken.
    """
    pats = patterns(np.flatnonzero(hist), limit)
    x = fit_counts(pats, hist.astype(float))
    plans = [_packed(hist, limit, pats, share * x) for share in SHARES]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _packed(hist: np.ndarray, limit: int, pats: np.ndarray, x: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    left = hist.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern, most=None):
        need = np.bincount(pattern)
        used = np.flatnonzero(need)
        n = int((left[used] // need[used]).min())
        n = n if most is None else min(n, most)
        if n > 0:
            left[used] -= n * need[used]
            out.append((tuple(int(p) for p in pattern), n))
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 1:
            break
        take(pats[i][pats[i] > 0], int(x[i]))
    while left.any():                   # best-fit decreasing on counts: each pass uses up a length
        room, pattern = limit, []
        while room:
            fits = np.flatnonzero(left[:room + 1] > np.bincount(pattern, minlength=limit + 1)[:room + 1])
            if not len(fits):
                break
            pattern.append(int(fits[-1]))
            room -= pattern[-1]
        take(np.array(pattern))
    return out


class Slots:
    """The plan as arrays: for a length and a number within it, the sequence and the offset."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]], limit: int):
        base, rows = 0, []
        for lengths, n in planned:
            at, by = 0, {}
            for x in sorted(lengths, reverse=True):
                by.setdefault(x, []).append(at)
                at += x
            rows += [(x, n * len(offs), base, len(offs), offs[0]) for x, offs in by.items()]
            base += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.sequences = base
        self.first = np.searchsorted(table[:, 0], np.arange(limit + 2))
        ends = np.cumsum(table[:, 1])
        self.begin = ends - table[:, 1]           # running over all lengths
        self.base, self.many, self.offset = table[:, 2], table[:, 3], table[:, 4]

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.begin[self.first[length]] + number
        i = np.searchsorted(self.begin, key, side="right") - 1
        within = key - self.begin[i]
        # equal lengths stand side by side in a sequence
        return self.base[i] + within // self.many[i], self.offset[i] + within % self.many[i] * length


def pack(df: DataFrame, token_files: tuple, end: int, limit: int, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    spark = df.sparkSession
    made = materialize(pieces(df, token_files, end, limit, id_col, text_col, with_ids), "pieces")
    counts = materialize(made.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    hist = np.zeros(limit + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():     # at most ``limit`` rows
        hist[r["length"]] = r["n"]
    slots = spark.sparkContext.broadcast(Slots(plan(hist, limit), limit))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    numbered = made.join(shift, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("shift")).alias("number"), *(["ids"] if with_ids else []))

    def place(b: pa.RecordBatch) -> pa.RecordBatch:
        seq, off = slots.value.find(b.column(3).to_numpy(), b.column(5).to_numpy())
        cols = [b.column(i) for i in range(5)] + [pa.array(seq), pa.array(off)] + ([b.column(6)] if with_ids else [])
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if with_ids else []))
    return map_batches(numbered, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
                       + (", ids array<int>" if with_ids else ""))
