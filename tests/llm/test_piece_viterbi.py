"""The search against the library's own unigram search, over the same pieces and scores."""

import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from tidewater.llm import piece_viterbi as V

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["  a  b ", "", None, "\n", "a\tb", "ﬁ 中文字 𐍈𐍈x", "▁x", "<s> </s> <0x0A>", "\x00a", "é" * 3, "aaaaaaaa" * 600, "   ",
         "x" + " " * 50 + "y", "The quick brown fox jumps over the lazy dog."]


def varint(b, i):
    r = s = 0
    while True:
        c, i = b[i], i + 1
        r |= (c & 127) << s
        s += 7
        if c < 128:
            return r, i


def packed(n):
    out = b""
    while True:
        out, n = out + bytes([n & 127 | (128 if n > 127 else 0)]), n >> 7
        if not n:
            return out


@pytest.fixture(scope="module")
def unigram():
    """The model file's pieces as a unigram model with the scores of our vocabulary."""
    v = V.Pieces(PATH, "zipf")
    score = {int(i): float(x) for _, ids, value, _ in v.by_length.values() for i, x in zip(ids, value)}
    raw, i, out, n = open(PATH, "rb").read(), 0, b"", 0
    while i < len(raw):
        key, i = varint(raw, i)
        size, i = varint(raw, i)
        body, i = raw[i:i + size], i + size
        if key >> 3 == 1:
            if n in score:
                k, j = varint(body, 1)
                body = body[:j + k] + b"\x15" + struct.pack("<f", score[n])
            n += 1
        elif key >> 3 == 2:
            at = body.index(b"\x18\x02", 0, 120)            # model type
            body = body[:at] + b"\x18\x01" + body[at + 2:]
        out += packed(key) + packed(len(body)) + body
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(out)
    return sp, v, score


def test_equals_the_library_but_for_ties(unigram, texts):
    sp, v, score = unigram
    every = [*TEXTS, *texts.values()]
    total = lambda ids: sum(score.get(i, 0.0) for i in ids)
    differ = 0
    for at, ids, o, s, *_ in V.encode_texts(pa.array(every), v):
        for k in range(len(o) - 1):
            mine, ref = ids[o[k]:o[k + 1]].tolist(), sp.encode(every[at + k] or "")
            differ += mine != ref
            assert total(mine) == pytest.approx(total(ref), rel=1e-6, abs=1e-6)
    assert differ < 0.1 * len(every)


def test_round_trip(unigram):
    _, v, _ = unigram
    for at, ids, o, *_ in V.encode_texts(pa.array(TEXTS), v):
        raw, ra = v.decode(ids, o)
        for k in range(len(o) - 1):
            assert raw[ra[k]:ra[k + 1]].tobytes().decode() == (TEXTS[at + k] or "").replace("▁", " ")


def test_decode_equals_the_library(unigram, texts):
    sp, v, _ = unigram
    ids = [sp.encode(t) for t in texts.values()]
    raw, at = v.decode(np.concatenate(ids).astype(np.int64), np.concatenate(([0], np.cumsum([len(i) for i in ids]))))
    assert [raw[at[k]:at[k + 1]].tobytes().decode() for k in range(len(ids))] == [sp.decode(i) for i in ids]


def test_blocks_do_not_change_a_long_word(unigram, monkeypatch):
    _, v, _ = unigram
    whole = [x.tolist() for x in next(V.encode_texts(pa.array(TEXTS), v))[1:3]]
    monkeypatch.setattr(V, "CELLS", 64)
    assert [x.tolist() for x in next(V.encode_texts(pa.array(TEXTS), v))[1:3]] == whole


def test_operator_on_odd_rows(spark, odd):
    got = V.check(odd, PATH, "zipf").collect()
    assert len(got) == odd.count() and all(r.round_trip for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (4, 5)} == {0}
    back = V.decode(V.encode(odd, PATH, "zipf"), PATH)
    want = sorted((repr(r.doc_id), (r.text or "").replace("▁", " ")) for r in odd.collect())
    assert sorted((repr(r.doc_id), r.text) for r in back.collect()) == want
    assert V.check(odd.limit(0), PATH, "zipf").collect() == [] and V.encode(odd.limit(0), PATH).collect() == []
