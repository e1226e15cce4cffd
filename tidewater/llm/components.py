"""Connected components of an edge table: union-find inside partitions, stars across them.

Each round contracts the edges of every partition with a union-find (in runs of
bounded length), then applies a large-star and a small-star step; rounds end when
the edges no longer change.  Hot nodes cost map-side minima and a join that can
be split; no component is ever brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize

EDGES_AT_ONCE = 500_000
SCHEMA = "u long, v long"


def spanning(u, v) -> tuple[list[int], list[int]]:
    """Edges (node, smallest node) of the components of the given edges."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root
    for a, b in zip(u, v):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    return nodes, [parent[x] for x in nodes]


def _contract(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0

        def flush():
            a, b = spanning(np.concatenate(us).tolist(), np.concatenate(vs).tolist())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])
        for b in batches:
            us.append(b.column(0).to_numpy())
            vs.append(b.column(1).to_numpy())
            n += b.num_rows
            if n >= EDGES_AT_ONCE:
                yield flush()
                us, vs, n = [], [], 0
        if n:
            yield flush()
    return edges.mapInArrow(run, SCHEMA)


def _stars(edges: DataFrame) -> DataFrame:
    both = materialize(edges.union(edges.select("v", "u")).distinct(), "edges")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return materialize(small.union(least).distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that is not its component's smallest; ``edges`` has columns u, v."""
    now, before = materialize(_contract(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u != v")), "forest"), None
    while True:
        now = _stars(now)
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = mark
        now = materialize(_contract(now), "forest")
