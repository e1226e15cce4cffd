"""Periodic runs of words, found by a sparse diagonal DP.

A run is a stretch of consecutive words of smallest period q (words q apart are
identical) that holds the period at least ``times`` times, has at least ``least``
words, and that no neighbouring word extends.  In the grid of (word, lag) it is a
diagonal on which at least (times - 1) * q neighbouring words match.

Only a few cells of that grid are visited.  Lags are taken in classes [2^k, 2^(k+1)):
(times - 1) * 2^k neighbouring matches hold a word whose number is a multiple of that
count, so such words alone look up their earlier occurrences at lags of the class.
Each occurrence opens a lag; the match lengths of all open lags of a class then
grow together, in steps of powers of two, on prefix sums of word hashes; a diagonal
that has ended is emitted if it is long enough, and dropped if not.  A class opens at
most a third of the words as lags, also where a text repeats a single word, so a text
of n words costs at most n log n.

A stretch whose length holds q four times and whose smallest period d is less than q
is the run of d itself (d divides q); of the diagonals over one stretch the shortest
lag is kept.

Defined results: null text is empty and has no words, no runs and an empty collapsed
text; repeated rows are answered each for itself; null ids are carried; an empty
table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewater.llm.common import id_and_text, short_batches
from tidewater.llm.text import SPACED, buffers, chunks, gathered, spans, word_hashes

TIMES, LEAST = 4, 6
# two moduli below 2^31 (products fit 64 bits) and a base for each
_FIELDS = ((2_147_483_647, 1_113_511_733), (2_147_483_629, 987_654_323))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Prefix:
    """Hashes of all stretches of a sequence from prefix sums, in two prime fields."""

    def __init__(self, h: np.ndarray):
        self.sums, self.powers = [], []
        for p, base in _FIELDS:
            power = np.ones(1, np.int64)
            while len(power) <= len(h):         # doubles at each step
                power = np.concatenate([power, power * (int(power[-1]) * base % p) % p])
            power = power[:len(h) + 1]
            terms = (h % np.uint64(p)).astype(np.int64) * power[:-1] % p
            self.sums.append(np.concatenate([[0], np.cumsum(terms) % p]))
            self.powers.append(power)

    def same(self, at: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` words at ``at`` and ``lag`` words earlier are equal."""
        out = np.ones(len(at), bool)
        for (p, _), s, power in zip(_FIELDS, self.sums, self.powers):
            late = (s[at + size] - s[at]) % p
            early = (s[at - lag + size] - s[at - lag]) % p
            out &= late == early * power[lag] % p
        return out

    def extend(self, at: np.ndarray, lag: np.ndarray, most: np.ndarray, forward: bool) -> np.ndarray:
        """Match lengths of the diagonals from ``at`` on (or before it), each at most ``most``."""
        got = np.zeros(len(at), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step := step >> 1:
            new = np.flatnonzero(got + step <= most)
            begin = at[new] + got[new] if forward else at[new] - got[new] - step
            new = new[self.same(begin, lag[new], np.full(len(new), step))]
            got[new] += step
        return got


def find(h: np.ndarray, first: np.ndarray, times: int = TIMES, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs in the documents whose words have the hashes ``h`` and begin at ``first`` (one entry
    more than documents): start in ``h``, length and period, by start, then period."""
    none = np.zeros(0, np.int64)
    total, size = len(h), np.diff(first)
    if not total:
        return none, none, none
    begin, end = np.repeat(first[:-1], size), np.repeat(first[1:], size)
    place = np.arange(total)
    local = place - begin
    # the occurrences of each word, in order
    order = np.argsort(h, kind="stable")
    word = np.empty(total, np.int64)
    word[order] = np.cumsum(np.concatenate([[0], h[order][1:] != h[order][:-1]]))
    seen = word[order] * total + order
    prefix, found = Prefix(h), []
    least_lag = 1
    while times * least_lag <= size.max():
        look = place[(local % ((times - 1) * least_lag) == 0) & (local >= least_lag) & (end - begin >= times * least_lag)]
        lo = np.searchsorted(seen, word[look] * total + np.maximum(look - 2 * least_lag + 1, begin[look]))
        hi = np.searchsorted(seen, word[look] * total + look - least_lag, side="right")
        many = hi - lo
        at = np.repeat(look, many)
        earlier = order[np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())]
        lag = at - earlier
        keep = times * lag <= (end - begin)[at]
        at, lag = at[keep], lag[keep]
        # a lag whose next or previous word differs on both sides ends here, with length 1
        after, before = np.minimum(at + 1, total - 1), np.maximum(at - 1, 0)
        goes_on = ((at + 1 < end[at]) & (h[after] == h[after - lag])) | ((at - lag > begin[at]) & (h[before] == h[before - lag]))
        short = np.maximum(least - lag, (times - 1) * lag) <= 1
        at, lag = at[goes_on | short], lag[goes_on | short]
        right = prefix.extend(at, lag, end[at] - at, True)
        left = prefix.extend(at, lag, at - lag - begin[at], False)
        length = left + right + lag
        long = length >= np.maximum(least, times * lag)
        found.append(np.unique(np.column_stack([(at - left - lag)[long], length[long], lag[long]]), axis=0))
        least_lag *= 2
    runs = np.concatenate([np.zeros((0, 3), np.int64), *found])
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.concatenate([[False], (np.diff(runs[:, 0]) == 0) & (np.diff(runs[:, 1]) == 0)])[:len(runs)]
    runs = runs[~again]                         # the shortest lag of a stretch is its period
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def kept_words(total: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Mask of the words that no run holds behind its first period."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge)[:total] == 0


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray, first: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    at = np.flatnonzero(keep)
    size = ends[at] - starts[at] + 1            # with a space behind
    cum = np.concatenate([[0], np.cumsum(size)])
    out = np.full(cum[-1], 0x20, np.uint8)
    source = np.arange(cum[-1]) + np.repeat(starts[at] - cum[:-1], size)
    inside = np.ones(cum[-1], bool)
    inside[cum[1:] - 1] = False
    out[inside] = data[source[inside]]
    words = np.searchsorted(at, first)          # the first kept word of each document
    texts = out.tobytes()
    return pa.array([texts[cum[a]:max(cum[b] - 1, cum[a])] for a, b in zip(words[:-1], words[1:])], pa.binary()).cast(pa.string())


def _answer(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, times: int, least: int) -> pa.RecordBatch:
    starts, ends, first = spans(data, offsets, SPACED)
    start, length, period = find(word_hashes(data, starts, ends), first, times, least)
    keep = kept_words(len(starts), start, length, period)
    by_doc = np.searchsorted(start, first)
    own = start - first[np.searchsorted(first, start, side="right") - 1]
    spans_of = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (own, length, period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(by_doc, pa.int32()), spans_of)
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(first)), runs, joined(data, starts, ends, keep, first)],
                                      ["doc_id", "n_words", "runs", "collapsed"])


def detect(df: DataFrame, times: int = TIMES, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's words, its runs (by start, then period) and its text without the repetitions:
    every run's first period is kept, words are joined by one space."""
    if times < 2:
        raise ValueError("a run holds its period twice at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches, 1):
            data, offsets = buffers(b.column(1))
            for i, part, off in chunks(data, offsets):
                yield _answer(b.column(0).slice(i, len(off) - 1), part, off, times, least)
    short_batches(df.sparkSession)
    return id_and_text(df, id_col, text_col).mapInArrow(run, SCHEMA)
