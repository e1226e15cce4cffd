"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union-find.

1.  One pass over the texts gives each document's distinct shingles (hashed to 64
    bits), a digest of that set and one key for each signature band.
2.  Documents with equal sets are one class; its smallest id stands for it, so a
    group of copies costs one row from here on.
3.  Classes that share a band key share a bucket.  The number of bands is chosen
    so that a pair at the threshold shares none with probability ``MISS`` at most.
4.  Links are confirmed on the full shingle sets, in blocks of bounded size.
    First round: each class meets the others that have the same smallest bucket
    partner, together with that partner.  What this connects needs no further
    comparison.  Second round: in buckets that still hold more than one component
    all pairs of different components are compared, block against block.  Equal
    buckets are compared once.
5.  Confirmed links (a spanning forest of each block) go to the component step.

Blocks emit confirmed links only, never candidate pairs.  A bucket of m classes
that are *not* linked with each other takes (m / BLOCK)^2 / 2 block comparisons,
spread over tasks: the price of losing no link among texts that resemble each
other just below the threshold.

Defined results: null or empty texts have no shingles and are linked with
nothing; so are rows with a null id (their component is null, and they are kept).
Rows that repeat an id are one document, linked through any of their texts; the
result repeats them.  An empty table gives an empty table.  ``groups`` leaves
other columns out; ``keep`` passes all columns on and keeps one row of an id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import id_and_text, map_batches, plain_names, short_batches, with_schema_of
from tidewater.llm.components import components, spanning
from tidewater.llm.superminhash_core import band_keys, bands_for, signatures
from tidewater.llm.text import buffers, chunks, shingle_sets
from tidewater.session import materialize

ROWS = 5            # signature values in a band
MISS = 1e-6         # a pair at the threshold may share no band with this probability
BLOCK = 256         # classes in a block
TOKENS_AT_ONCE = 4096


def signature_table(docs: DataFrame, k: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_digest, keys (one for each band) of every row."""
    def run(b: pa.RecordBatch) -> pa.Table:
        data, offsets = buffers(b.column(1))
        sizes, digests, keys = [], [], []
        for _, d, o in chunks(data, offsets):
            sets = shingle_sets(d, o, k)
            sizes += [len(s) for s in sets]
            digests += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            keys.append(band_keys(signatures(sets, bands * ROWS), ROWS))
        flat = pa.array(np.concatenate(keys).reshape(-1))
        return pa.table({"doc_id": b.column(0), "n_shingles": pa.array(sizes, pa.int64()), "set_digest": pa.array(digests, pa.binary()),
                         "keys": pa.FixedSizeListArray.from_arrays(flat, bands).cast(pa.list_(pa.int64()))})
    return map_batches(docs, run, "doc_id long, n_shingles long, set_digest binary, keys array<long>")


def set_table(docs: DataFrame, k: int) -> DataFrame:
    """rep, shingles (sorted 64-bit hashes as bytes)."""
    def run(b: pa.RecordBatch) -> pa.Table:
        data, offsets = buffers(b.column(1))
        sets = [s.tobytes() for _, d, o in chunks(data, offsets) for s in shingle_sets(d, o, k)]
        return pa.table({"rep": b.column(0), "shingles": pa.array(sets, pa.binary())})
    return map_batches(docs, run, "rep long, shingles binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, exactly."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    who = np.repeat(np.arange(n), [len(s) for s in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[token]
    who, token = who[keep], number[token[keep]]
    order = np.argsort(token, kind="stable")
    who, token = who[order], token[order]
    out = np.zeros((n, n), np.float32)
    for a in range(0, int(shared.sum()), TOKENS_AT_ONCE):      # counts below 2^24 are exact in float32
        lo, hi = np.searchsorted(token, [a, a + TOKENS_AT_ONCE])
        has = np.zeros((n, min(TOKENS_AT_ONCE, int(shared.sum()) - a)), np.float32)
        has[who[lo:hi], token[lo:hi] - a] = 1
        out += has @ has.T
    return np.rint(out).astype(np.int64)


def block_links(rep: list[int], comp: list[int], side: list[int], sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the confirmed links between different components.

    With two sides only pairs across them are compared: a side's own pairs have a block of their own.
    """
    comp_, size, side_ = np.array(comp), np.array([len(s) for s in sets]), np.array(side)
    live = np.triu(comp_[:, None] != comp_[None, :], 1)
    if len(set(side)) > 1:
        live &= side_[:, None] != side_[None, :]
    live &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    if not live.any():
        return [], []
    used = np.flatnonzero(live.any(0) | live.any(1))
    both = overlaps([sets[i] for i in used])
    union = size[used][:, None] + size[used][None, :] - both
    a, b = np.nonzero(live[np.ix_(used, used)] & (100 * both >= percent * union))
    return spanning([rep[used[i]] for i in a], [rep[used[i]] for i in b])


def confirm(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) found in blocks.  ``rows``: block key columns b1, b2, b3, then rep, comp, side."""
    placed = rows.join(sets, "rep").select("b1", "b2", "b3", "rep", "comp", "side", "shingles")
    placed = placed.repartition("b1", "b2", "b3").sortWithinPartitions("b1", "b2", "b3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, found = None, [], ([], [])

        def close():
            if len({r[1] for r in block}) > 1:
                u, v = block_links(*[[r[i] for r in block] for i in (0, 1, 2)], [np.frombuffer(r[3], np.uint64) for r in block], percent)
                found[0].extend(u)
                found[1].extend(v)
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for *k, rep, comp, side, shingles in zip(*cols):
                if k != key:
                    close()
                    key, block = k, []
                block.append((rep, comp, side, shingles))
            if len(found[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["u", "v"])
                found = ([], [])
        close()
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["u", "v"])
    short_batches(rows.sparkSession)
    return materialize(placed.mapInArrow(run, "u long, v long"), "links")


def links(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of the class representatives that are linked to a smaller one."""
    exploded = reps.select("rep", F.explode("keys").alias("key"))
    buckets = exploded.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").select("key", "hub")
    members = materialize(exploded.join(buckets, "key"), "buckets")
    own = materialize(members.groupBy("rep").agg(F.min("hub").alias("hub")), "hubs")
    sets = materialize(set_table(docs.join(own.select("rep"), docs.doc_id == F.col("rep"), "left_semi"), k), "sets")

    # first round: a class, those of the same smallest partner, and that partner
    others = own.where("hub < rep")
    sizes = materialize(others.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / (BLOCK - 1)).cast("int").alias("parts")), "hub-sizes")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    first = others.join(sizes, "hub").select(F.col("hub").alias("b1"), part.alias("b2"), F.lit(0).alias("b3"), "rep", F.col("rep").alias("comp"), F.lit(0).alias("side")) \
        .union(sizes.select(F.col("hub").alias("b1"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("b2"), F.lit(0).alias("b3"),
                            F.col("hub").alias("rep"), F.col("hub").alias("comp"), F.lit(0).alias("side")))
    links1 = confirm(first, sets, percent)
    joined = components(links1)

    # second round: buckets that still hold several components, equal ones once
    state = materialize(members.select("key", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
                        .select("key", "rep", F.coalesce("component", "rep").alias("comp")), "bucket-components")
    several = state.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("n"), F.min("rep").alias("r0"),
                                       F.max("rep").alias("r1"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("all")).where("c0 < c1")
    several = materialize(several.groupBy("n", "r0", "r1", "all").agg(F.min("key").alias("key"))
                          .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "mixed-buckets")
    here = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("side")
    second = state.join(several, "key").select("key", "rep", "comp", here, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")) \
        .select(F.col("key").alias("b1"), F.least("side", "other").alias("b2"), F.greatest("side", "other").alias("b3"), "rep", "comp", "side")
    links2 = confirm(second, sets, percent)
    return components(links1.union(links2))


def groups(df: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row: documents are linked when
    100 * intersection >= percent * union of their sets of ``k``-word shingles."""
    docs = id_and_text(df, id_col, text_col)
    signed = materialize(signature_table(docs, k, bands_for(percent / 100, ROWS, MISS)), "signatures")
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_digest").agg(F.min(F.struct("doc_id", "keys")).alias("own"))
    reps = materialize(classes.select("set_digest", F.col("own.doc_id").alias("rep"), F.col("own.keys").alias("keys")), "classes")
    # an id with several texts stands for several classes
    extra = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("set_digest").alias("a"), F.max("set_digest").alias("b")).where("a != b")
    twins = signed.join(extra, "doc_id").join(reps.select("set_digest", "rep"), "set_digest").select("doc_id", "rep")
    linked = links(reps, docs, k, percent)
    if not (several := materialize(twins, "several-texts")).isEmpty():
        linked = components(linked.select(F.col("node").alias("u"), F.col("component").alias("v"))
                            .union(several.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
                            .union(several.select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))))
    to = materialize(reps.select("set_digest", "rep").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("set_digest", F.coalesce("component", "rep").alias("component_id")), "class-components")
    out = signed.select("doc_id", "n_shingles", "set_digest").join(to, "set_digest", "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep(df: DataFrame, k: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the one with the smallest id."""
    judged = materialize(groups(df, k, percent, id_col, text_col), "groups")
    dropped = materialize(judged.where(~F.col("kept")).select(F.col("doc_id").alias("dropped")).distinct(), "dropped")
    rows, own = plain_names(df), F.col(f"c{df.columns.index(id_col)}")
    out = rows.join(dropped, own.cast("long") == F.col("dropped"), "left_anti")
    if not judged.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        # an id that occurs more than once keeps one of its rows
        out = out.where(own.isNull()).unionByName(out.where(own.isNotNull()).dropDuplicates([f"c{df.columns.index(id_col)}"]))
    return with_schema_of(out, df)
