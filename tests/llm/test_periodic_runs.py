import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tidewater.llm import periodic_runs as P
from tidewater.llm.queries import QUERIES

from .conftest import SF


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w, times=4, least=6):
    """Every lag and every stretch on it; a stretch with a shorter period is that period's."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - s + q
            if n >= max(least, times * q) and not any(all(w[j] == w[j + d] for j in range(s, s + n - d)) for d in range(1, q)):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def answer(doc_id, text):
    w = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), s, n, q, n and n * 1000 // q, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(collapsed(w, runs).encode()).hexdigest())


def test_query_matches_brute_force(spark, texts):
    got = QUERIES["op13_periodic_runs"](spark, SF).collect()
    want = {i: answer(i, t) for i, t in texts.items() if len(t) < 20_000}
    assert len(got) == len(texts) and {r[0]: tuple(r) for r in got if r[0] in want} == want
    assert sum(r.n_runs > 0 for r in got) > 10


def test_odd_rows_and_empty_table(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect() if len(r.text or "") < 20_000]
    found = P.detect(odd)
    key = [(repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect() if r.n_words < 4000]
    want = [(repr(i), len(w := words_of(t)), brute_runs(w), collapsed(w, brute_runs(w))) for i, t in rows]
    assert sorted(key) == sorted(want)
    assert P.detect(odd.limit(0)).collect() == []


def hashes(w):
    return np.array(w, np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@pytest.mark.parametrize("times, least", [(4, 6), (2, 2), (3, 10)])
def test_small_alphabets_against_brute_force(times, least):
    rng = random.Random(1)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 50), rng.randint(1, 4)
            w = [rng.randrange(k) for _ in range(n)]
            if n > 3 and rng.random() < 0.6:
                a = rng.randrange(n - 3)
                p = 1 + rng.randrange((n - a) // 3)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        got = P.find(hashes([x for d in docs for x in d]), first, times, least)
        want = [(int(first[i]) + s, n, q) for i, d in enumerate(docs) for s, n, q in brute_runs(d, times, least)]
        assert list(zip(*(x.tolist() for x in got))) == want


def test_long_repetitive_texts_take_near_linear_time():
    for h, want in ((np.full(300_000, 7, np.uint64), (0, 300_000, 1)), (hashes(np.arange(300_000) % 1000), (0, 300_000, 1000)),
                    (hashes(np.concatenate([np.zeros(999, int), [1]] * 300)), None)):
        t0 = time.time()
        runs = list(zip(*(x.tolist() for x in P.find(h, np.array([0, len(h)])))))
        assert time.time() - t0 < 30
        assert want is None or runs == [want]
    assert (0, 300_000, 1000) in runs and len(runs) == 301


def test_a_hash_that_overflows_is_no_trap():
    """Thue-Morse words and their opposites: equal under a polynomial hash modulo 2^64."""
    t = np.array([bin(i).count("1") % 2 for i in range(4096)])
    assert list(P.find(hashes(np.concatenate([t, 1 - t] * 2)), np.array([0, 4 * 4096]))[0]) == []


def test_a_run_holds_its_period_at_least_twice(odd):
    with pytest.raises(ValueError):
        P.detect(odd, times=1)
