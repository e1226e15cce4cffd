"""Whole-batch text primitives on Arrow string buffers.

Words are found and hashed for a whole batch of documents at once, straight on
the UTF-8 bytes: no Python object per word.  Every word class used here is
decided by ASCII bytes alone (bytes of multi-byte characters are always at least
0x80), so byte masks and code-point patterns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_GOLDEN = _U(0x9E3779B97F4A7C15)
LONG_WORD = 512          # bytes; longer words are hashed one by one

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.large_string())
    arr = col.fill_null("").cast(pa.large_string())
    _, off, data = arr.buffers()
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1, arr.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20, docs: int = 1 << 16) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Split a batch into runs of whole documents of about ``limit`` bytes and at most ``docs`` documents:
    (first document, bytes, offsets)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n, i + docs)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each document's first word (one more entry than documents)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    cut = offsets[1:-1]
    before[cut[cut < len(data)]] = False
    after[cut[cut > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time for all words together."""
    size = ends - starts
    h = size.astype(np.uint64) * _GOLDEN
    if not len(size):
        return h
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[:len(data)] = data
    eight = np.ndarray((len(data) + 8,), "<u8", padded.data, strides=(1,))
    active, step = np.flatnonzero(size <= LONG_WORD), 0
    while len(active):
        left = size[active] - step
        h[active] = mix(h[active] * _M1 ^ (eight[starts[active] + step] & _MASKS[np.minimum(left, 8)]))
        step += 8
        active = active[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes())
    return h


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside each document, with offsets by document.

    A document of 1 to k-1 words has one shingle, its whole sequence; without
    words it has none.
    """
    n_words = np.diff(first)
    counts = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    offsets = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(offsets[-1], np.uint64)
    if not len(out):
        return out, offsets
    full = np.zeros(max(len(hashes) - k + 1, 0), np.uint64) + _U(k)
    for j in range(k):
        full = mix(full * _GOLDEN + hashes[j:j + len(full)])
    within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)
    at = np.repeat(first[:-1], counts) + within
    long_doc = np.repeat(n_words >= k, counts)
    out[long_doc] = full[at[long_doc]]
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        v = np.full(1, n_words[d], np.uint64)
        for w in hashes[first[d]:first[d + 1]]:
            v = mix(v * _GOLDEN + w)
        out[offsets[d]] = v[0]
    return out, offsets


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Per document the sorted distinct shingle hashes of its lower-cased words."""
    low = LOWER[data]
    starts, ends, first = spans(low, offsets, SPACED)
    sh, off = shingles(word_hashes(low, starts, ends), first, k)
    return [np.unique(sh[off[i]:off[i + 1]]) for i in range(len(off) - 1)]


def gathered(batches: Iterator[pa.RecordBatch], text_at: int, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Join short batches until their texts hold about ``limit`` bytes: fewer, larger vector operations."""
    run, size = [], 0
    for b in batches:
        if b.num_rows:
            run.append(b)
            size += b.column(text_at).nbytes
        if size >= limit:
            yield pa.Table.from_batches(run).combine_chunks().to_batches()[0]
            run, size = [], 0
    if run:
        yield pa.Table.from_batches(run).combine_chunks().to_batches()[0]
