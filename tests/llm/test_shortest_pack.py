import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewater.llm import shortest_pack as S
from tidewater.llm.queries import PACK_FILES, QUERIES

from .conftest import SF


def check_packing(rows, got, limit, end):
    """Every id in one piece, pieces side by side, nothing padded, no more sequences than the tokens fill."""
    tok = Tokenizer.from_file(PACK_FILES[0])
    want = {}
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], "<u4")
        want.setdefault(repr(i), []).append(ids)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(repr(r.doc_id), []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for i, texts in want.items():
        pieces = by_doc[i]
        assert sum(n for _, n, _, _ in pieces) == sum(map(len, texts))
        for start, n, crc, tokens in pieces:
            assert any(tokens == len(x) and start + n <= len(x) and zlib.crc32(x[start:start + n].tobytes()) == crc for x in texts)
        if len(texts) == 1:
            at = 0
            for start, n, _, _ in sorted(pieces):
                assert start == at
                at += n
    tokens = 0
    for pieces in by_seq.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at == limit or at < limit and at & (at - 1) == 0
        tokens += at
    assert len(by_seq) == tokens // limit + bin(tokens % limit).count("1")


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_packs_every_id_without_padding(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    check_packing(rows, QUERIES["op12_shortest_pack"](spark, folder).collect(), 2048, 1)


@pytest.mark.parametrize("limit", [16, 100, 2048])
def test_odd_rows_and_empty_table(odd, limit):
    check_packing([(r.doc_id, r.text) for r in odd.collect()], S.pack(odd, PACK_FILES, 1, limit).collect(), limit, 1)
    assert S.pack(odd.limit(0), PACK_FILES, 1, limit).collect() == []


def test_ids_travel_with_the_pieces(odd):
    for r in S.pack(odd, PACK_FILES, 1, 64, with_ids=True).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32


def laid_out(hist, limit):
    """Sequences from the plan, and how many pieces they hold."""
    places, sequences, pieces = S.Places(S.plan(hist, limit), limit), {}, 0
    for n in np.flatnonzero(hist):
        rank, at = np.arange(hist[n]), np.zeros(hist[n], np.int64)
        while len(rank):
            size, seq, off = places.find(np.full(len(rank), n), rank, at)
            for s, o, k in zip(seq.tolist(), off.tolist(), size.tolist()):
                sequences.setdefault(s, []).append((o, k))
            pieces += len(rank)
            at = at + size
            assert (size > 0).all() and (at <= n).all()
            rank, at = rank[at < n], at[at < n]
    return sequences, pieces


def test_plans_fill_their_packs():
    rng = random.Random(2)
    for _ in range(300):
        limit, hist = rng.choice([4, 16, 30, 64]), None
        hist = np.zeros(limit + 1, np.int64)
        for _ in range(rng.randint(0, 8)):
            hist[rng.randint(1, limit)] += rng.choice([1, 2, 5, 100])
        for pieces in laid_out(hist, limit)[0].values():
            at = 0
            for off, n in sorted(pieces):
                assert off == at
                at += n
            assert at == limit or at & (at - 1) == 0


def test_documents_are_cut_only_where_no_pack_has_room():
    hist = np.zeros(2049, np.int64)
    hist[1024] = 100            # two a sequence: nothing to cut
    assert laid_out(hist, 2048)[1] == 100
    hist = np.bincount(np.clip(np.random.default_rng(1).lognormal(5, 1, 20_000).astype(int), 1, 2048), minlength=2049)
    assert laid_out(hist, 2048)[1] < 1.07 * 20_000


def test_longest_first_into_the_shortest_pack():
    hist = np.zeros(11, np.int64)
    hist[6] = hist[5] = hist[3] = hist[2] = hist[4] = 1          # 20 tokens, two sequences of ten
    sequences, _ = laid_out(hist, 10)
    assert sorted(tuple(n for _, n in sorted(p)) for p in sequences.values()) == [(5, 4, 1), (6, 3, 1)]


def test_a_frequent_length_is_no_long_plan():
    hist = np.zeros(2049, np.int64)
    hist[1], hist[1100], hist[300] = 10**9, 10**8, 10**8
    assert len(S.plan(hist, 2048)) < 1000
