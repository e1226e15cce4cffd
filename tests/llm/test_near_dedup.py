import re

import numpy as np
import pytest

from tidewater.llm import near_dedup as N
from tidewater.llm.components import components, spanning
from tidewater.llm.superminhash_core import bands_for, signatures


WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def sets_of(text, k):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    """Sorted (id, shingles, component, kept); ids may repeat."""
    sets = [(i, sets_of(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return sorted((repr(i), len(s), repr(c := None if i is None else find(i) if s else i), c == i) for i, s in sets)


def mine(df, k, percent):
    return sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in N.groups(df, k, percent).collect())


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(documents, texts, k, percent):
    assert mine(documents, k, percent) == brute(list(texts.items()), k, percent)


def test_odd_rows_and_empty_table(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert mine(odd, 3, 85) == brute(rows, 3, 85)
    assert mine(odd.limit(0), 3, 85) == []


def near_copies(n, words=60, edits=6, seed=1):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for p in rng.choice(words, rng.integers(0, edits), replace=False):
            w[p] = f"v{rng.integers(50)}"
        out.append(" ".join(w))
    return out


def test_a_mixed_group_over_many_blocks(spark, monkeypatch):
    """Texts just above and just below the threshold, in blocks of four: every link counts."""
    monkeypatch.setattr(N, "BLOCK", 4)
    rows = list(enumerate(near_copies(60)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 3, 85)
    assert len({w[2] for w in want}) > 3        # several groups
    assert mine(df, 3, 85) == want


def test_a_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 6:i * 6 + 100])) for i in range(16)]
    want = brute(rows, 3, 85)
    assert len({w[2] for w in want}) == 1
    assert mine(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85) == want


def test_an_id_with_several_texts_links_them(spark):
    a, b = near_copies(2, seed=3)[0], " ".join(f"q{i}" for i in range(30))
    rows = [(1, a), (5, a), (5, b), (7, b), (9, "alone")]
    assert mine(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85) == brute(rows, 3, 85)


def test_keep_passes_all_columns_and_one_row_of_a_group(odd):
    kept = N.keep(odd, 5, 80)
    assert kept.schema == odd.schema
    got = sorted(repr(r.doc_id) for r in kept.collect())
    want = brute([(r.doc_id, r.text) for r in odd.collect()], 5, 80)
    assert got == sorted([w[0] for w in want if w[0] == "None"] + sorted({w[0] for w in want if w[3] and w[0] != "None"}))
    assert N.keep(odd.limit(0), 5, 80).collect() == []


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 60, 400).astype(np.uint64)
    for share in (0.2, 0.6, 0.9):
        b = np.concatenate([a[:int(400 * share)], rng.integers(0, 1 << 60, 400 - int(400 * share)).astype(np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = signatures([np.unique(a), np.unique(b)], 2048)
        assert abs((s[0] == s[1]).mean() - true) < 0.04
        assert (np.floor(s) < 2048).all()


def test_signature_of_parts_is_the_least(monkeypatch):
    from tidewater.llm import superminhash_core as C
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 500).astype(np.uint64))
    whole = signatures([a], 64)
    monkeypatch.setattr(C, "ELEMENTS_AT_ONCE", 37)
    assert np.array_equal(signatures([a], 64), whole) and np.isinf(signatures([a[:0]], 64)).all()


def test_enough_bands():
    for t in (0.8, 0.85):
        assert (1 - t ** N.ROWS) ** bands_for(t, N.ROWS, 1e-6) <= 1e-6


def test_overlaps_equal_brute_force(monkeypatch):
    monkeypatch.setattr(N, "TOKENS_AT_ONCE", 5)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = N.overlaps(sets)
    assert all(got[i][j] == want[i][j] for i in range(9) for j in range(9) if i != j)


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(500 + i, 501 + i) for i in range(80)]
    u, v = spanning(*zip(*edges))
    got = components(spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()
    assert sorted((r.node, r.component) for r in got) == sorted(zip(u, v))
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
