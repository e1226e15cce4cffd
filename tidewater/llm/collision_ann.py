"""Approximate nearest neighbours by collision counting with query-aware windows.

Each hash is a single projection.  A block of vectors keeps, for each
projection, its values sorted.  A query opens a window around its own value on
every projection; a vector inside the window collides there.  Virtual rehashing
widens all windows step by step; a vector's places in the sorted arrays, held
against the windows, give its collision count.
Once enough vectors have collided on at least ``SHARE`` of the projections, all
of these are verified with their exact inner product.

Largest inner product is turned into nearest distance by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm (0 for queries, which are scaled to
norm M).  The projections are random orthonormal bases.

All rows are indexed, in blocks of about ``BLOCK`` rows; the query rows meet
each block in blocks of their own, so no task sees more than a block of each.
Of identical vectors only the k+1 smallest ids are kept, which loses nothing:
they score alike, a query drops at most its own id, and ties go to smaller ids.

Defined results: vectors that are null, zero, hold null or non-finite
components take no part, nor do rows with a null id; vectors of different
lengths do not meet, each length is searched among its own; repeated rows count once; an id with several vectors
counts with its best; an empty table gives an empty table; other columns are
not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import col
from tidewater.session import materialize

BLOCK, QUERY_BLOCK = 16384, 1024
PROJECTIONS = 64         # at least; whole orthonormal bases are drawn
SHARE = 0.75             # of the projections that a vector must collide on
ENOUGH, LEAST = 0.08, 400   # candidates wanted: this share of the block's vectors, and this many at least
RADII = (0.2, 0.4, 0.6, 0.9, 1.2, 1.5, 1.8, 2.2, 2.7, 3.3, 4.0, 6.0, 10.0)   # half windows, in typical projected lengths
SCHEMA = "query_id long, vec_id long, score double"


def projections(dim: int, at_least: int = PROJECTIONS, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-at_least // dim))], axis=1)


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, largest: float):
        self.ids, self.x, self.largest = ids, x, largest
        self.directions = projections(x.shape[1] + 1)
        lift = np.sqrt(np.maximum(largest ** 2 - np.einsum("ij,ij->i", x, x), 0.0))
        values = np.column_stack([x, lift]) @ self.directions
        order = np.argsort(values, axis=0, kind="stable").T
        self.sorted = np.ascontiguousarray(np.sort(values, axis=0).T)
        kind = np.uint16 if len(ids) < 1 << 16 else np.uint32
        self.place = np.empty(order.shape, kind)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=kind)[None, :], axis=1)
        self.shifted, self.inside = np.empty_like(self.place), np.empty(order.shape, bool)
        self.counter = np.uint8 if len(order) < 256 else np.uint16
        self.unit = largest / np.sqrt(x.shape[1] + 1)

    def bounds(self, at: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Windows of a radius around projected queries: one row for each query and a column for each projection."""
        r = radius * self.unit
        lo = np.column_stack([np.searchsorted(s, at[:, j] - r, "left") for j, s in enumerate(self.sorted)])
        hi = np.column_stack([np.searchsorted(s, at[:, j] + r, "right") for j, s in enumerate(self.sorted)])
        return lo.astype(self.place.dtype), hi.astype(self.place.dtype)

    def candidates(self, window, start: int) -> tuple[np.ndarray, int]:
        """Vectors that collide often enough, at the first radius (from ``start`` on) with enough of them.

        A vector collides on a projection if its place in the sorted array lies in the window.
        """
        n, m = len(self.ids), len(self.place)
        need, share = min(n, max(LEAST, int(ENOUGH * n))), int(np.ceil(SHARE * m))
        for r in range(start, len(RADII)):
            lo, hi = window(r)
            np.subtract(self.place, lo[:, None], out=self.shifted)      # unsigned: places before the window wrap around
            np.less(self.shifted, (hi - lo)[:, None], out=self.inside)
            found = np.flatnonzero(np.add.reduce(self.inside.view(np.uint8), axis=0, dtype=self.counter) >= share)
            if len(found) >= need:
                return found, r
        return np.arange(n), r              # too few even at the largest radius: all are verified

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vector id, score) of the ``k`` best verified vectors of each query."""
        q_out, v_out, s_out = [], [], []
        norms = np.linalg.norm(queries, axis=1, keepdims=True)
        at = np.column_stack([queries / norms * self.largest, np.zeros(len(queries))]) @ self.directions
        made: dict[int, tuple] = {}
        usual = 0.0             # where searches of this block ended so far, as a running mean
        for i, (own, q) in enumerate(zip(query_ids, queries)):
            def window(r, i=i):
                if r not in made:
                    made[r] = self.bounds(at, RADII[r])
                return made[r][0][i], made[r][1][i]
            c, r = self.candidates(window, int(max(usual - 0.5, 0)))
            usual = r if not i else 0.9 * usual + 0.1 * r
            c = c[self.ids[c] != own]
            score = np.einsum("ij,j->i", self.x[c], q)
            if len(c) > 4 * k:          # all that tie with the k-th stay in
                part = score >= np.partition(score, len(c) - k)[len(c) - k]
                c, score = c[part], score[part]
            best = np.lexsort((self.ids[c], -score))[:k]
            q_out.append(np.full(len(best), own))
            v_out.append(self.ids[c[best]])
            s_out.append(score[best])
        return np.concatenate(q_out), np.concatenate(v_out), np.concatenate(s_out)


def _vectors(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = t.column("vec_id").to_numpy()
    flat = t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, flat.reshape(len(ids), -1)


def search(df: DataFrame, is_query, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best found for every row of ``df`` where ``is_query``
    (a function of the id Column) holds."""
    v = F.col("vector")
    usable = df.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))) & F.exists(v, lambda a: a != 0))
    rows = materialize(usable.dropDuplicates(["vec_id", "vector"]), "vectors")
    dim = F.size("vector")
    norm2 = F.aggregate("vector", F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double"))
    lengths = rows.groupBy(dim.alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("norm2"),
                                                 F.count(F.when(is_query(F.col("vec_id")), 1)).alias("queries")).collect()
    if not lengths:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    largest = {r["dim"]: float(r["norm2"]) ** 0.5 for r in lengths}

    def of_length(count: dict[int, int]):
        return F.create_map(*[F.lit(x) for pair in count.items() for x in pair])[dim]
    blocks = of_length({r["dim"]: -(-r["n"] // BLOCK) for r in lengths})
    query_blocks = of_length({r["dim"]: max(1, -(-r["queries"] // QUERY_BLOCK)) for r in lengths})

    twins = Window.partitionBy("vector").orderBy("vec_id")
    index = rows.withColumn("_twin", F.row_number().over(twins)).where(F.col("_twin") <= k + 1).select(
        "vec_id", "vector", dim.alias("dim"), F.pmod(F.xxhash64("vec_id"), blocks.cast("long")).alias("block"),
        F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("query_block"))
    queries = rows.where(is_query(F.col("vec_id"))).select(
        "vec_id", "vector", dim.alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)).alias("block"),
        F.pmod(F.xxhash64(F.lit("query"), "vec_id"), query_blocks).cast("int").alias("query_block"))

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            out = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            out = Block(*_vectors(left), largest[key[0].as_py()]).search(*_vectors(right), k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), out)))
    found = index.groupBy("dim", "block", "query_block").cogroup(queries.groupBy("dim", "block", "query_block")).applyInArrow(meet, SCHEMA)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
