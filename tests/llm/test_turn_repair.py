import hashlib
import random
import sys
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from tidewater.llm import turn_repair as R
from tidewater.llm.queries import QUERIES, damaged_turns

from .conftest import SF

SPACES = " \t\n\x0b\x0c\r"
sys.setrecursionlimit(20_000)       # the plain search below goes down a conversation turn by turn


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(SPACES)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, costs=R.Costs()):
    """(cost, edits, repaired turns): every edit tried at every turn, the least pair taken."""
    bad = faults(rows)
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        if inserts:
            c, e, t = best(i, follow[last], inserts - 1)
            options.append((c + costs.insert, "I" + e, ({"u": "user", "a": "assistant"}[follow[last]] + ":",) + t))
        if i < len(rows):
            role, text = rows[i]
            c, e, t = best(i + 1, last, 3)
            options.append((c + costs.delete, "D" + e, t))
            if bad[i] not in ("blank", "duplicate"):
                more = costs.truncated * (bad[i] == "truncated")
                if role[:1] and role[:1] == follow[last] or last == "" and role[:1] == "s":
                    c, e, t = best(i + 1, role[0], 3)
                    options.append((c + more, "K" + e, (f"{role}:{text}",) + t))
                c, e, t = best(i + 1, follow[last], 3)
                options.append((c + more + costs.rerole, "R" + e, ({"u": "user", "a": "assistant"}[follow[last]] + ":" + text,) + t))
        return min(options, key=lambda o: o[:2], default=(float("inf"), "", ()))
    return best(0, "", 3)


def expected(rows, costs=R.Costs()):
    """The answer for the turns (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = [r[1:] for r in rows]
    kinds, numbers = faults(said), [r[0] for r in rows if r[0] is not None]
    initials = [r[:1] for r, _ in said]
    cost, edits, turns = cheapest(tuple(said), costs)
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
            hashlib.sha256("\n".join(turns).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damage(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        conv_name, turn_name = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{conv_name}:{turn_name}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def check(rows, got):
    left = {}
    for conv, *rest in damage(rows):
        left.setdefault(conv, []).append(tuple(rest))
    want = {c: expected(left.get(c, [])) for c in {r[0] for r in rows}}
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_matches_brute_force(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(rows, QUERIES["op11_turn_repair"](spark, folder).collect())


@pytest.mark.parametrize("costs", [R.Costs(), R.Costs(1, 1, 1, 0), R.Costs(2, 1, 5, 2), R.Costs(3, 2, 1, 1)])
def test_tables_match_every_edit_tried(costs):
    rng, tables = random.Random(5), R.tables(costs)
    for _ in range(400):
        rows = tuple((rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["", "a.", "b.", "c!", "cut", "  ", f"{rng.random()}."])) for _ in range(rng.randint(0, 11)))
        symbols = "".join(str(R.GONE if f in ("blank", "duplicate") else "sua".find(r[:1] or "?") % 4 + 4 * (f == "truncated")) for (r, _), f in zip(rows, faults(rows)))
        assert tables.repair(symbols) == cheapest(rows, costs)[:2]


def test_vectors_are_few():
    assert len(R.tables(R.Costs()).vectors) < 100


def test_a_negative_cost_or_a_free_insertion_is_refused():
    for bad in ({"rerole": -1}, {"insert": 0}):
        with pytest.raises(ValueError):
            R.Costs(**bad)


SCHEMA = "conv_id long, turn long, role string, text string, place long, `a.b` string, marks string"


def test_odd_rows(spark):
    long = "word " * 50_000 + "."
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", long), (1, None, "system", "Be brief."), (1, 9, None, None),
            (2, None, None, None), (None, 3, "user", "Who am I?"), (None, 4, "assistant", "No."), (None, None, "tool", "x"),
            (3, 5, "", "no name."), (3, 5, "usher", "kept as it is."), (4, -2, "user", "\n\t"), (5, 2, "assistant", "𐍈 ends "),
            *[(6, t, ("user", "assistant")[t % 2], f"{t}." if t % 7 else "again.") for t in range(60)]]
    df = spark.createDataFrame([(*r, 1, "x", "m") for r in rows], SCHEMA).repartition(4)
    turns = R.turns(df)
    check(rows, R.report(damaged_turns(turns), turns).collect())
    assert R.report(R.turns(df.limit(0)), R.turns(df.limit(0))).collect() == []


def test_long_conversations_cross_segments_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 64)
    rng = random.Random(3)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["ok.", "cut", f"{t}."])) for t in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = R.report(R.turns(df), R.turns(df)).collect()
    assert tuple(got[0][c] for c in COLUMNS) == expected([r[1:] for r in rows])


def test_repaired_turns_read_back(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (2, 0, "assistant", "d.")]
    placed = R.numbered(R.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    edits = R.audit(placed)
    out = {}
    for r in R.repaired(placed, edits).orderBy("conv_id", "place").collect():
        out.setdefault(r.conv_id, []).append((r.place, r.edit, r.role, r.text))
    assert out[1] == [(0, "K", "user", "a."), (1, "I", "assistant", ""), (2, "K", "user", "b."), (3, "K", "assistant", "c.")]
    assert {r.conv_id: (r.cost, r.audit) for r in edits.collect()} == {1: (3, "KIKK"), 2: (3, "IK")}
    assert [x[1:] for x in out[2]] == [("I", "user", ""), ("K", "assistant", "d.")]


def test_no_conversation_is_numbered_in_one_task(spark):
    df = spark.createDataFrame([(1, None, "user", "same.")] * 4000, "conv_id long, turn long, role string, text string")
    placed = R.numbered(R.turns(df))
    assert placed.select(F.countDistinct("place")).first()[0] == 4000
    assert spark.read.parquet(*placed.inputFiles()).select("_pid").distinct().count() > 1
