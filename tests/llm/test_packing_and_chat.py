import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidewater.llm import chat_format as C
from tidewater.llm import pattern_packing as P
from tidewater.llm.queries import ORACLE, PACK_FILES, QUERIES

from .conftest import SF


# ---------------------------------------------------------------- packing
def check_packing(rows, got, limit, end):
    tok = Tokenizer.from_file(PACK_FILES[0])
    want = []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], "<u4")
        want += [(repr(i), k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(P.cut(len(ids), limit))]
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for off, n in sorted(pieces):
            assert off == at
            at += n
        assert at <= limit
    return len(by), -(-sum(r.length for r in got) // limit)


def test_query_packs_tightly(spark, texts):
    n, least = check_packing(list(texts.items()), QUERIES["op9_pattern_packing"](spark, SF).collect(), 1024, 2)
    assert n <= least * 1.05 + 2


@pytest.mark.parametrize("limit", [16, 1024])
def test_odd_rows_and_empty_table(odd, limit):
    check_packing([(r.doc_id, r.text) for r in odd.collect()], P.pack(odd, PACK_FILES, 2, limit).collect(), limit, 2)
    assert P.pack(odd.limit(0), PACK_FILES, 2, limit).collect() == []


def test_ids_travel_with_the_pieces(odd):
    for r in P.pack(odd, PACK_FILES, 2, 64, with_ids=True).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_cut():
    assert P.cut(5, 10) == [(0, 5)] and P.cut(10, 10) == [(0, 10)] and P.cut(25, 10) == [(0, 5), (5, 10), (15, 10)] and P.cut(20, 10) == [(0, 10), (10, 10)]


def best_possible(hist, limit):
    """Plain best-fit decreasing, piece by piece, is to be matched within a hundredth."""
    bins = np.zeros(limit + 1, np.int64)       # how many sequences have so much room
    used = 0
    for n in np.repeat(np.arange(limit + 1), hist)[::-1]:
        room = np.flatnonzero(bins[n:])
        if len(room):
            r = n + int(room[0])
            bins[r] -= 1
        else:
            r, used = limit, used + 1
        bins[r - n] += 1
    return 1.01 * used + 3


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    limit = 64
    hist = np.zeros(limit + 1, np.int64)
    hist[1:] = rng.integers(0, 400, limit) if seed % 2 else rng.geometric(0.01, limit) * (rng.random(limit) < 0.6)
    planned = P.plan(hist, limit)
    used = np.zeros_like(hist)
    for lengths, n in planned:
        assert sum(lengths) <= limit and n > 0
        np.add.at(used, list(lengths), n)
    assert used.tolist() == hist.tolist()
    assert sum(n for _, n in planned) <= best_possible(hist, limit)
    slots, seen = P.Slots(planned, limit), set()
    for length in np.flatnonzero(hist):
        seq, off = slots.find(np.full(hist[length], length), np.arange(hist[length]))
        seen |= {(int(s), int(o), int(length)) for s, o in zip(seq, off)}
    assert len(seen) == hist.sum()
    fill = {}
    for s, o, n in sorted(seen):
        assert fill.get(s, 0) == o
        fill[s] = o + n


def test_least_squares_fit_is_non_negative_and_close():
    pats = P.patterns(np.arange(1, 33), 32)
    assert (pats.sum(axis=1) == 32).all()
    true = np.random.default_rng(0).integers(0, 50, len(pats)).astype(float)
    hist = sum(np.bincount(pats[:, j], true, 33) for j in range(3))
    hist[0] = 0
    x = P.fit_counts(pats, hist)
    again = sum(np.bincount(pats[:, j], x, 33) for j in range(3))
    assert (x >= 0).all() and np.abs(again - hist)[1:].max() < 0.02 * hist.max()


def test_fast_tokenizer_gives_equal_ids(texts):
    both, slow = P.Tokenizer(*PACK_FILES), P.Tokenizer(PACK_FILES[0])
    for t in [*texts.values(), "a <|endoftext|> b", "x y z\x85", "中文 🙂", "\t\n\r  "]:
        assert both.ids(t).tolist() == slow.ids(t).tolist()


# ---------------------------------------------------------------- chat
T = C.Template()
TEXTS = ["", "\\", "</turn>", "\\### Assistant: </turn> ok", "### User: hi</turn>\n### Assistant: no", "#### System: x", "\\\\</turn", "a\nb"]


def formatted(turns):
    return "".join(s for role, text in turns for s, _ in T.segments(role, text))


def test_round_trip():
    roles = ["system", "user", "assistant", "tool", "", "odd: role\\", "### User: "]
    turns = [(r, t) for r in roles for t in TEXTS]
    assert C.read_back(formatted(turns), T) == turns
    rng = np.random.default_rng(1)
    parts = ["\\", "</turn>", "### User: ", "### Role ", ": ", "\n", "x", "#", "<"]
    for _ in range(500):
        turns = [("".join(rng.choice(parts, 3)) if rng.random() < 0.3 else "user", "".join(rng.choice(parts, rng.integers(0, 6)))) for _ in range(3)]
        assert C.read_back(formatted(turns), T) == turns


@pytest.mark.parametrize("roles, ok", [("su", True), ("sua", True), ("uaua", True), ("a", False), ("uu", False), ("uata", True), ("s", False), ("us", False), ("uat", False)])
def test_machine(roles, ok):
    names, state = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}, ""
    for r in roles:
        state = T.step(state, names[r])
    assert (state in T.ends) is ok


def want_digests(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    res = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        res[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(formatted(turns)))
    return res


def test_digests_of_odd_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", TEXTS[3]), (1, 1, "assistant", TEXTS[3]), (2, None, None, None), (2, 5, "assistant", ""),
            (None, 3, "user", "x" * 100_000), (None, 1, "system", "é "), (3, 2, "ghost", "boo"), (3, 1, "assistant", "### Role x: ")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, valid string, place long").repartition(3)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in C.digests(df).collect()}
    assert got == want_digests(rows)
    assert C.digests(df.limit(0)).collect() == [] and C.segments(df.limit(0)).collect() == []
    whole = {}
    for r in C.segments(df).orderBy("conv_id", "place").collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.text
    assert {k: len(C.read_back(v, T)) for k, v in whole.items()} == {k: v[0] for k, v in got.items()}


def test_query_equals_brute_force_and_sql(spark):
    from tests.oracle_compare import compare, duck
    got = QUERIES["op10_chat_format"](spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", TEXTS[3]), (-7, 1, "assistant", TEXTS[3])]
    assert {r.conv_id: tuple(r)[1:6] for r in got} == want_digests(rows)
    assert compare(spark, duck(SF), "op10", QUERIES["op10_chat_format"], ORACLE["op10_chat_format"], SF)["ok"]


class Merging(C.Template):
    """A faulty template: a user's closing marker inside a text is written as it stands, and so is the end of a turn that says ``join``."""

    def segments(self, role, text):
        opening, body, close = super().segments(role, text)
        return [opening, body, ("", False) if text == "join" else close]


def test_figures_come_from_the_joined_text(spark):
    rows = [(1, 0, "user", "join"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (2, 0, "user", "x"), (2, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    right = {r.conv_id: r for r in C.digests(df).collect()}
    merged = {r.conv_id: r for r in C.digests(df, Merging()).collect()}
    assert right[1].n_turns == 3 and merged[1].n_turns == 2 and merged[1].turns_sha256 != right[1].turns_sha256
    assert merged[2] == right[2]
    with pytest.raises(Exception, match="does not end with a turn"):
        C.digests(df.where("turn = 0"), Merging()).collect()


def test_a_long_conversation_is_streamed(spark):
    n = 30_000
    df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, ' </turn>') AS text")
    r = C.digests(df).first()
    assert r.n_turns == n and r.valid
    assert r.turns_sha256 == hashlib.sha256("".join(f"{('user', 'assistant')[i % 2]}\nt{i} </turn>\n" for i in range(n)).encode()).hexdigest()
