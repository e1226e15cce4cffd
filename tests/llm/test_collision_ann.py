import numpy as np
import pytest

from tidewater.llm import collision_ann as A
from tidewater.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, score double, vector string, rank int, block long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0, "x", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k, every):
    best = {}
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, x in ok:
        if q % every == 0:
            for i, y in ok:
                if i != q:
                    s = float((x * y).sum())
                    best.setdefault(q, {})[i] = max(s, best.get(q, {}).get(i, -np.inf))
    return {q: sorted(b.items(), key=lambda t: (-t[1], t[0]))[:k] for q, b in best.items()}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], rel=1e-12)


def test_small_tables_equal_brute_force(spark):
    """Fewer vectors than are always verified: the result is exact, also with odd rows."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).round(3).tolist()) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (60, rows[3][1])]                            # ties
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [None] * 8), (280, [float("inf")] + [0.0] * 7),
             (None, rows[1][1]), (300, []), (rows[0][0], rows[0][1])]                           # no part; a repeated row
    want = brute(rows, 5, 20)
    same(found(A.search(frame(spark, rows).repartition(3), lambda i: i % 20 == 0, 5)), want)


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [9.0, 9.0])]
    same(found(A.search(frame(spark, rows), lambda i: i % 20 == 0, 20)), brute(rows, 20, 20))


def test_many_identical_vectors(spark):
    """A group of copies far larger than k: the smallest ids win, the query's own is left out."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(20)]
    same(found(A.search(frame(spark, rows), lambda i: i % 20 == 0, 7)), brute(rows, 7, 20))


def test_empty_table_and_no_usable_vector(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        got = A.search(frame(spark, rows), lambda i: i % 20 == 0, 5)
        assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.collect() == []


def test_recall_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK", 700)
    monkeypatch.setattr(A, "QUERY_BLOCK", 20)
    monkeypatch.setattr(A, "LEAST", 40)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 24)) * rng.uniform(0.3, 2, (2000, 1))       # norms differ
    rows = [(i, v) for i, v in enumerate(x.round(4).tolist())]
    want, got = brute(rows, 10, 20), found(A.search(frame(spark, rows), lambda i: i % 20 == 0, 10))
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.9
    for q in got:
        assert got[q] == sorted(got[q], key=lambda t: (-t[1], t[0]))


def test_query_recall(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows, 20, 20), found(QUERIES["op8_collision_ann"](spark, sf))
    assert sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_collision_counts_by_hand(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 6))
    b = A.Block(np.arange(300), x, float(np.linalg.norm(x, axis=1).max()))
    lift = np.sqrt(np.maximum(b.largest ** 2 - (x * x).sum(1), 0))
    values = np.column_stack([x, lift]) @ b.directions
    at = np.append(x[:1] / np.linalg.norm(x[0]) * b.largest, [[0.0]], axis=1) @ b.directions
    lo, hi = b.bounds(at, 1.2)
    want = (np.abs(values - at) <= 1.2 * b.unit).sum(1)
    got = ((b.place >= lo[0][:, None]) & (b.place < hi[0][:, None])).sum(0)
    assert got.tolist() == want.tolist()


def test_each_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3 if i < 60 else 5).round(3).tolist()) for i in range(100)]
    got = found(A.search(frame(spark, rows), lambda i: i % 20 == 0, 4))
    want = brute(rows[:60], 4, 20) | brute(rows[60:], 4, 20)
    assert set(got) == {0, 20, 40, 60, 80}
    same(got, want)
