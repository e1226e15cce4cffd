"""SuperMinHash signatures of many sets at once, in numpy.

Each element draws a random permutation of the signature's slots step by step
(Fisher-Yates).  At step j it offers the value j + u, with u uniform in [0, 1),
to its j-th slot; a slot keeps the smallest offer.  Offers of different steps
are ordered (the correlated ranks that lower the variance against plain
MinHash).  A set is finished early, once no slot holds more than the next
step's least offer: long sets need two or three steps instead of one draw for
each slot.
"""

from __future__ import annotations

import math

import numpy as np

from tidewater.llm.text import _GOLDEN, _U, mix

ELEMENTS_AT_ONCE = 200_000
_STEP = np.cumsum(np.full(1 << 14, _GOLDEN))      # a stream offset for each draw (wraps modulo 2^64)


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signature values, one row of ``m`` for each set (infinite for an empty set)."""
    sig = np.full((len(sets), m), np.inf)
    sizes = np.array([len(s) for s in sets], np.int64)
    i = 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + sizes[j] <= ELEMENTS_AT_ONCE):
            total += sizes[j]
            j += 1
        if total:
            elements = np.concatenate(sets[i:j])
            doc = np.repeat(np.arange(j - i), sizes[i:j])
            for a in range(0, len(elements), ELEMENTS_AT_ONCE):     # a very long set goes piece by piece
                _offer(sig[i:j], elements[a:a + ELEMENTS_AT_ONCE], doc[a:a + ELEMENTS_AT_ONCE])
        i = j
    return sig


def _offer(sig: np.ndarray, elements: np.ndarray, doc: np.ndarray) -> None:
    m = sig.shape[1]
    flat = sig.reshape(-1)          # rows of sig are contiguous: a view
    perm = np.tile(np.arange(m, dtype=np.uint16 if m > 256 else np.uint8), (len(elements), 1))
    active = np.arange(len(elements))
    for j in range(m):
        seed = elements[active]
        u = (mix(seed + _STEP[2 * j]) >> _U(11)).astype(np.float64) * 2.0 ** -53
        k = j + ((mix(seed + _STEP[2 * j + 1]) >> _U(32)) * _U(m - j) >> _U(32)).astype(np.int64)
        slot = perm[active, k]
        perm[active, k] = perm[active, j]
        np.minimum.at(flat, doc[active] * m + slot, u + j)
        unfinished = sig.max(axis=1) > j + 1
        active = active[unfinished[doc[active]]]
        if not len(active):
            return


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """Bands needed so that a pair at ``threshold`` shares no band with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-threshold ** rows))


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` signature values; an empty set's row is meaningless."""
    bits = sig.view(np.uint64)
    n, m = bits.shape
    keys = np.empty((n, m // rows), np.uint64)
    for b in range(m // rows):
        k = np.full(n, b + 1, np.uint64)
        for r in range(rows):
            k = mix(k * _GOLDEN + bits[:, b * rows + r])
        keys[:, b] = k
    return keys.view(np.int64)
