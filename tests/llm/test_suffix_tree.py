import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import suffix_tree as S
from tidewater.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return WORD.findall((text or "").translate(LOW)) + ["\n"]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def check(rows, got):
    """Base figures against brute force, rows taken as a multiset."""
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), held(i), len(ws := tokens(t)), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, t in rows)
    mine = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert [m[:5] for m in mine] == [w[:5] for w in want]
    assert [m[5] for m in mine] == pytest.approx([w[5] for w in want], rel=1e-9)


def split():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op6_suffix_tree_lm"](spark, SF).collect()


def test_base_scores_equal_brute_force(scored, texts):
    check(list(texts.items()), scored)


def test_words_beyond_the_head_are_joined(spark, documents, texts, monkeypatch):
    monkeypatch.setattr(S, "HEAD", 8)
    check(list(texts.items()), S.score(documents, split()).collect())


def test_tree_scores_are_log_probabilities(scored):
    assert all(r.score < 0 and math.isfinite(r.score) for r in scored)


def test_odd_rows_and_empty_table(spark, odd):
    got = S.score(odd, split()).collect()
    check([(r.doc_id, r.text) for r in odd.collect()], got)
    assert S.score(odd.limit(0), split()).collect() == []


def test_everything_held_out(spark, odd):
    got = S.score(odd, F.lit(True)).collect()
    assert {r.train_tokens for r in got} == {0} and {r.n_known for r in got} == {0} and {r.base_score for r in got} == {0.0}


def model(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return S.Tree(S.tree_table(S.counts(docs)).toArrow())


def keys_of(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return S.grams(data, np.array([0, len(data)]))


def test_distributions_sum_to_one(spark):
    tree = model(spark, ["ab ab ab ac"] * 40 + ["ba ca"] * 9)
    assert any(len(level[0]) for level in tree.levels)
    for context in (b" ab a", b"zzzzz", b"\n\n\n\na"):
        base = sum(c << 8 * k for k, c in enumerate(context))       # the oldest in the lowest byte
        assert tree.probabilities(base + (np.arange(256) << 40)).sum() == pytest.approx(1.0)


def test_longest_retained_suffix_equals_brute_force(spark):
    texts = ["the cat sat", "the cat ran", "a dog sat", "the dog ran"] * 30
    tree, counts = model(spark, texts), Counter()
    streams = [b"\n" * S.DEPTH + t.encode() + b"\n" for t in texts]
    for s in streams:
        for i in range(S.DEPTH, len(s)):
            for k in range(S.DEPTH + 1):
                counts[s[i - k:i], s[i]] += 1
    total, kinds = Counter(), Counter()
    for (c, _), n in counts.items():
        total[c] += n
        kinds[c] += 1
    kept = set()
    for c in total:
        least = max(S.LEAST_TIMES, S.LEAST_SHARE * total[b""])
        if c and total[c] >= least:
            gain = sum(n * math.log(n / total[c] / (counts[c[1:], a] / total[c[1:]])) for (d, a), n in counts.items() if d == c)
            if gain >= S.LEAST_GAIN and gain >= S.COST * kinds[c] * math.log(total[c]):
                kept |= {c[j:] for j in range(len(c))}

    def p(context, a):
        out = (counts[b"", a] + 1) / (total[b""] + 256)
        for k in range(1, S.DEPTH + 1):
            c = context[-k:]
            if c not in kept:
                break
            out = (counts[c, a] + S.PULL * kinds[c] * out) / (total[c] + S.PULL * kinds[c])
        return out
    probe = "the cat sat on a dog\n"
    padded = b"\n" * S.DEPTH + probe.encode()
    want = [p(padded[i:i + S.DEPTH], padded[i + S.DEPTH]) for i in range(len(probe))]
    keys = keys_of(probe)
    order = np.argsort(keys)
    assert kept and tree.probabilities(keys[order]).tolist() == pytest.approx(np.array(want)[order].tolist())


def test_learning_helps_on_held_out_text(spark):
    got = QUERIES["op6_suffix_tree_lm"](spark, SF.replace("sf0.001", "sf0.01"))
    r = got.where("held_out").agg(F.sum("score"), F.sum("n_tokens"), F.sum(F.length(F.lit("x")))).first()
    even = math.log10(1 / 256)       # a uniform guess for each byte; words have more than four bytes with their blank
    assert r[0] / r[1] > 4 * even * 0.55


def test_contexts_are_kept_by_times_and_divergence_in_a_large_corpus(spark):
    """A context seen 1,999 times among 1e9 symbols; the deepest one has seven symbols."""
    def key(context, symbol):
        return int(np.array([int.from_bytes(context + symbol, "little")], np.uint64).view(np.int64)[0])
    rows = [(0, key(b"aaaaaaa", b"a"), 10 ** 9), (0, key(b"qrstuvw", b"x"), 1999), (0, key(b"Qrstuvw", b"y"), 1999), (0, key(b"aaaaaaa", b"\xe9"), 7)]
    tree = S.Tree(S.tree_table(spark.createDataFrame(rows, "kind int, key long, n long")).toArrow())
    assert int.from_bytes(b"qrstuvw", "little") in tree.levels[7][0]


@pytest.mark.parametrize("bound", [0, 300, 3000])
def test_contexts_beyond_the_broadcast_ones_are_joined(spark, odd, documents, monkeypatch, bound):
    docs = documents.select("doc_id", "text").limit(60).union(odd.select("doc_id", "text"))
    want = sorted((repr(r.doc_id), r.n_known, r.base_score, r.score) for r in S.score(docs, split()).collect())
    monkeypatch.setattr(S, "TREE_ROWS", bound)
    got = sorted((repr(r.doc_id), r.n_known, r.base_score, r.score) for r in S.score(docs, split()).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [x for g in got for x in g[2:]] == pytest.approx([x for w in want for x in w[2:]], rel=1e-9)
