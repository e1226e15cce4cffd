"""Language-model scores from a probabilistic suffix tree.

Symbols are the bytes of a text's lower-cased words, one blank between words and
one end mark; the tree predicts the next symbol from the longest retained suffix
of at most ``DEPTH`` preceding symbols.

*   All (context, next symbol) counts of the training texts are gathered: each
    task counts its own and packs them by the three newest symbols of the context, so that
    a bucket has all that is needed to judge the longer ones.  Counts of shorter contexts
    are sums over the longest ones.
*   A context is a candidate if it was seen ``LEAST_TIMES``, whatever the size of
    the table.  It is retained if its next-symbol counts diverge from those of its
    suffix: n * KL must exceed ``COST`` times the number of its symbols times ln n
    (and ``LEAST_GAIN``).  Suffixes of retained contexts are retained.
*   A retained context's distribution is smoothed towards its suffix's, whose
    weight is ``PULL`` for each symbol seen after the context, down to the root,
    which adds one to each of 256 symbols.

The tree grows with the corpus.  Its most frequent contexts, with ``TREE_ROWS``
rows at most, are broadcast; a suffix is at least as frequent as its context, so
they form a tree themselves.  A filter of ``FILTER_BITS`` bits says which contexts may be among the
others: where a text leaves the tree at such a context, the gram meets the rest of its contexts in a join.  Words (for the
unigram base score) are treated alike: those that make up at least 1 / ``HEAD``
of all tokens (so ``HEAD`` at most) are broadcast, and the tokens of all others
meet their counts in a join.

Defined results: null or empty text is the end mark alone; a null id counts as
the empty string when the split is made; rows are scored one by one, repeated
rows alike, each learning as often as it occurs; with nothing to learn from every
count is 0; an empty table gives an empty table; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import id_and_text, short_batches
from tidewater.llm.text import LOWER, SPACED, buffers, chunks, gathered, mix, spans, word_hashes
from tidewater.session import materialize

DEPTH = 7                # longest context, in symbols (with the next one, the eight bytes of a key)
LEAST_SHARE = 0.0        # no share of all symbols is asked of a candidate
LEAST_TIMES = 5          # but so many times
LEAST_GAIN, COST = 5.0, 0.3     # n * KL, in nats
PULL = 5.0               # weight of the suffix's distribution in the smoothing, for each symbol seen
HEAD = 1 << 21           # words that are broadcast, at most
TREE_ROWS = 8_000_000    # rows (context, symbol) of the tree that are broadcast, at most (about 120 MB)
FILTER_BITS = 1 << 27    # of the filter of the other contexts (16 MB)
AT_ONCE = 1 << 20        # bytes of text
KEYS_AT_ONCE = 1 << 20   # keys that a task holds before it merges them, and passes them on if half of that many differ
PIECE_ROWS = 1 << 19     # rows of the tree that reach the driver at once
EXACT = 1 << 24          # below it, whole numbers fit a float of four bytes
BLOCK_KEYS = 1 << 16     # keys in one row of a bucket
LOCAL = 3                # contexts that agree in so many newest symbols are judged in one bucket
BLANK, END = 0x20, 0x0A  # neither occurs in a word
END_TOKEN = 1            # the end mark's key among the words
GRAM, WORD, DOC = 0, 1, 2
CONTEXT = "key & (shiftleft(1L, 8 * level) - 1)"      # of a row with level and key
NAMES = ["kind", "key", "row", "times", "info"]


def streams(low: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all documents, one after the other, and each document's offset."""
    n_words = np.diff(first)
    units = np.maximum(n_words, 1)                     # a document without words is an end mark
    size = np.zeros(units.sum(), np.int64)
    at = np.concatenate(([0], np.cumsum(units)))
    word_unit = np.arange(len(starts)) + np.repeat(at[:-1] - first[:-1], n_words)
    size[word_unit] = ends - starts
    marks = np.cumsum(size + 1) - 1
    out = np.empty(marks[-1] + 1 if len(marks) else 0, np.uint8)
    text = np.ones(len(out), bool)
    text[marks] = False
    out[text] = low[SPACED[low]]
    out[marks] = BLANK
    last = marks[at[1:] - 1]
    out[last] = END
    return out, np.concatenate(([0], last + 1))


def grams(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Key of each symbol with its ``DEPTH`` predecessors: the symbol in byte 5, its five newest predecessors
    below it (the newest in byte 4), the two older ones in bytes 7 and 6.  Before a text stand end marks."""
    n = np.diff(offsets)
    pad = DEPTH * np.arange(1, len(n) + 1)                    # marks before each text's symbols
    at = np.arange(len(symbols)) + np.repeat(pad, n)
    spaced = np.full(len(symbols) + DEPTH * len(n) + 8, END, np.uint8)
    spaced[at] = symbols
    eight = np.ndarray((len(spaced) - 7,), "<u8", spaced.data, strides=(1,))
    key = eight[at - DEPTH]
    return (key >> np.uint64(16) | key << np.uint64(48)).view(np.int64)


def by_symbol(keys: np.ndarray) -> np.ndarray:
    """Keys of ``grams`` with the symbol in the highest byte, then the newest predecessor, and so on."""
    key = keys.view(np.uint64)
    return key << np.uint64(16) | key >> np.uint64(48)


def word_keys(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Odd keys of the words (rows of documents get even ones)."""
    return (word_hashes(low, starts, ends) | np.uint64(1)).view(np.int64)


class _Counter:
    """Key counts of one kind, merged now and then."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None:
            keys, n = np.unique(keys, return_counts=True)
        self.parts.append((keys, n.astype(np.uint32) if not len(n) or n.max() < 1 << 24 else n))      # narrow until they are summed
        self.size += len(self.parts[-1][0])
        if len(self.parts) > 8 and self.size > 4 * len(self.parts[0][0]):      # what came since is worth a merge
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys and their counts."""
        if len(self.parts) > 1:
            keys, n = (np.concatenate(x) for x in zip(*self.parts))
            self.parts = []
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            self.parts = [(keys[first], np.add.reduceat(n, first, dtype=np.int64))]
        self.size = sum(len(k) for k, _ in self.parts)
        return (self.parts[0][0], self.parts[0][1].astype(np.int64)) if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merge()
        self.parts, self.size = [], 0
        return out


def _planes(values: np.ndarray) -> bytes:
    """Eight bytes a value, all first bytes before all second ones: sorted keys and small counts then compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _values(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams whose three newest predecessors agree share a bucket; words are spread by their hash."""
    of = keys >> np.uint64(32) & np.uint64(0xFFFFFF) if kind == GRAM else keys
    return (mix(of) % np.uint64(buckets)).astype(np.int32)


PACKED = "bucket int, kind int, keys binary, times binary"


def _packed(kind: int, keys: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts (sorted by key) as a few rows for each bucket, of ``BLOCK_KEYS`` keys at most."""
    bucket = _bucket(kind, keys, buckets)
    order = np.argsort(bucket, kind="stable")
    keys, n, bucket = keys[order], n[order], bucket[order]
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    for a, b in zip(edges[:-1], edges[1:]):
        for i in range(a, b, BLOCK_KEYS):
            j = min(i + BLOCK_KEYS, b)
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int32()), pa.array([kind], pa.int32()),
                                              pa.array([_planes(keys[i:j])]), pa.array([_planes(n[i:j].astype(np.int64))])], ["bucket", "kind", "keys", "times"])


def _buckets(spark) -> int:
    return min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16)


def _counted(docs: DataFrame, buckets: int) -> DataFrame:
    """Each task's counts of grams and words, by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Counter(), _Counter()
        for b in gathered(batches, 0, AT_ONCE):
            data, offsets = buffers(b.column(0))
            for _, d, o in chunks(data, offsets, AT_ONCE):
                low = LOWER[d]
                starts, ends, first = spans(low, o, SPACED)
                own[GRAM].add(by_symbol(grams(*streams(low, o, starts, ends, first))))
                own[WORD].add(np.append(word_keys(low, starts, ends), np.full(len(o) - 1, END_TOKEN)).view(np.uint64))
                for kind, c in enumerate(own):
                    if c.size > KEYS_AT_ONCE and len(c.merge()[0]) > KEYS_AT_ONCE // 2:
                        yield from _packed(kind, *c.take(), buckets)
        for kind, c in enumerate(own):
            if c.size:
                yield from _packed(kind, *c.take(), buckets)
    short_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(run, PACKED)


def _pack_rows(all_counts: DataFrame, buckets: int) -> DataFrame:
    """Rows (kind, key, n) by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, key, n = (b.column(i).to_numpy() for i in range(3))
            for k in np.unique(kind):
                own = np.flatnonzero(kind == k)
                own = own[np.argsort(key[own].view(np.uint64), kind="stable")]
                yield from _packed(int(k), key[own].view(np.uint64), n[own], buckets)
    return all_counts.select("kind", "key", "n").mapInArrow(run, PACKED)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, keys, counts) of each bucket, from its rows in a row."""
    now, counter = None, _Counter()
    for b in batches:
        for bucket, kind, keys, n in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (bucket, kind) != now:
                if now:
                    yield now[1], *counter.take()
                now = bucket, kind
            counter.add(_values(keys, np.uint64), _values(n, np.int64))
    if now:
        yield now[1], *counter.take()


def _together(packed: DataFrame) -> DataFrame:
    return packed.repartition("bucket").sortWithinPartitions("bucket", "kind")


def _slices(names: list[str], *cols) -> Iterator[pa.RecordBatch]:
    """Record batches of 64 k rows at most."""
    table = pa.Table.from_arrays([pa.array(c) for c in cols], names)
    yield from table.to_batches(max_chunksize=1 << 16)


def counts(docs: DataFrame) -> DataFrame:
    """kind, key, n: counts of grams and words of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, keys, n in _merged(batches):
            yield from _slices(["kind", "key", "n"], np.full(len(keys), kind, np.int32), keys.view(np.int64), n)
    return _together(_counted(docs, _buckets(docs.sparkSession))).mapInArrow(run, "kind int, key long, n long")


REDUCED = "kind int, level int, key long, n long, n_context long, symbols long, held boolean"


def _level(keys: np.ndarray, n: np.ndarray, level: int) -> dict:
    """Rows of one level from the sorted rows of the deepest, with their contexts' figures."""
    key = keys >> np.uint64(8 * (DEPTH - level))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    key, n = key[first], np.add.reduceat(n, first)
    contexts, at, symbols = np.unique(key & np.uint64((1 << 8 * level) - 1), return_inverse=True, return_counts=True)
    total = np.zeros(len(contexts), np.int64)
    np.add.at(total, at, n)
    return {"key": key, "n": n, "contexts": contexts, "at": at, "total": total, "symbols": symbols}


def _retained(keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray]]:
    """(level, rows, rows to pass on, whether a longer context holds theirs) of a bucket: from level ``LOCAL + 1`` on
    the rows of retained contexts; of level ``LOCAL`` all."""
    levels = [_level(keys, n, k) for k in range(LOCAL, DEPTH + 1)]
    keep = [np.zeros(len(levels[0]["contexts"]), bool)]
    for suffix, own in zip(levels, levels[1:]):
        up = np.searchsorted(suffix["key"], own["key"] >> np.uint64(8))
        p, q = own["n"] / own["total"][own["at"]], suffix["n"][up] / suffix["total"][suffix["at"][up]]
        gain = np.bincount(own["at"], own["n"] * np.log(p / q), len(own["contexts"]))
        keep.append((own["total"] >= LEAST_TIMES) & (gain >= LEAST_GAIN) & (gain >= COST * own["symbols"] * np.log(own["total"])))
    for k in range(len(levels) - 1, 0, -1):      # suffixes of what is retained
        up = np.searchsorted(levels[k - 1]["contexts"], levels[k]["contexts"][keep[k]] >> np.uint64(8))
        keep[k - 1][up] = True
    for k, (own, kept) in enumerate(zip(levels, keep)):
        rows = np.flatnonzero(kept[own["at"]]) if k else np.arange(len(own["key"]))
        yield LOCAL + k, own, rows, kept[own["at"]][rows]


def _reduced(packed: DataFrame) -> DataFrame:
    """Words with their counts; rows of retained contexts longer than ``LOCAL``; all rows of that length, of which ``held`` says
    whether a longer context holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in REDUCED.split(", ")]
        for kind, keys, n in _merged(batches):
            if kind == WORD:
                none = np.zeros(len(keys), np.int64)
                yield from _slices(names, np.full(len(keys), WORD, np.int32), none.astype(np.int32), keys.view(np.int64), n, none, none, none > 0)
                continue
            for level, own, rows, held in _retained(keys, n):
                at = own["at"][rows]
                yield from _slices(names, np.full(len(rows), GRAM, np.int32), np.full(len(rows), level, np.int32), own["key"][rows].view(np.int64),
                                   own["n"][rows], own["total"][at], own["symbols"][at].astype(np.int64), held)
    return _together(packed).mapInArrow(run, REDUCED)


def tree_table(all_counts: DataFrame) -> DataFrame:
    """level, key (symbol and context), n, and n_context and symbols of the retained contexts."""
    return _tree(materialize(_reduced(_pack_rows(all_counts.where(F.col("kind") == GRAM), _buckets(all_counts.sparkSession))), "tree-parts"))


def _tree(reduced: DataFrame) -> DataFrame:
    """The tree, from the buckets' parts: contexts of ``LOCAL`` symbols at most are few, and are judged together."""
    deep = reduced.where((F.col("kind") == GRAM) & (F.col("level") > LOCAL)).select("level", "key", "n", "n_context", "symbols")
    least = reduced.where((F.col("kind") == GRAM) & (F.col("level") == LOCAL))
    rest = least.select("key", "n")
    levels = rest.select(F.lit(LOCAL).alias("level"), "key", "n")
    for level in reversed(range(LOCAL)):
        rest = rest.groupBy(F.expr("shiftrightunsigned(key, 8)").alias("key")).agg(F.sum("n").alias("n"))
        levels = levels.union(rest.select(F.lit(level).alias("level"), "key", "n"))
    # a context has at most 256 next symbols, so its rows can be gathered
    levels = levels.withColumn("context", F.expr(CONTEXT))
    often = levels.groupBy("level", "context").agg(F.sum("n").alias("n_context"), F.collect_list(F.struct("key", "n")).alias("each")) \
        .where((F.col("n_context") >= LEAST_TIMES) | (F.col("level") == 0))
    rows = materialize(often.select("level", "context", "n_context", F.size("each").cast("long").alias("symbols"), F.inline("each")), "candidates")
    above = rows.select((F.col("level") + 1).alias("level"), F.col("key").alias("suffix_key"), F.col("n").alias("n_suffix"), F.col("n_context").alias("n_suffix_context"))
    gain = F.col("n") * F.ln((F.col("n") / F.col("n_context")) / (F.col("n_suffix") / F.col("n_suffix_context")))
    kept = rows.where("level > 0").withColumn("suffix_key", F.expr("shiftrightunsigned(key, 8)")).join(above, ["level", "suffix_key"]) \
        .groupBy("level", "context", "n_context", "symbols").agg(F.sum(gain).alias("gain")) \
        .where((F.col("gain") >= LEAST_GAIN) & (F.col("gain") >= COST * F.col("symbols") * F.ln("n_context"))).select("level", "context")
    kept = kept.union(least.where("held").select("level", F.expr(CONTEXT).alias("context")).distinct())
    closed = kept.select("context", F.col("level").alias("of"), F.explode(F.sequence(F.lit(0), "level")).alias("level")) \
        .select("level", F.expr("shiftrightunsigned(context, 8 * (of - level))").alias("context"))
    closed = closed.union(rows.where("level = 0").select("level", "context")).distinct()
    return deep.union(rows.join(closed, ["level", "context"]).select("level", "key", "n", "n_context", "symbols"))


def head_times(tree: DataFrame) -> int:
    """Least number of times of the contexts that are broadcast, so that they have ``TREE_ROWS`` rows at most: a number
    below 64, or a power of two."""
    step = F.when(F.col("n_context") < 64, F.col("n_context")).otherwise(F.expr("shiftleft(1L, cast(floor(log2(n_context)) as int))"))
    held, least = 0, 1 << 62
    for r in sorted(tree.where("level > 0").groupBy(step.alias("times")).count().collect(), reverse=True):     # at most 128 rows
        held += r["count"]
        if held > TREE_ROWS:
            break
        least = r["times"]
    return least


def _bits(level: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Place of each context in the filter."""
    return mix(context + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(FILTER_BITS - 1)


def tail_filter(tail: DataFrame) -> np.ndarray | None:
    """A bit for each context of ``tail`` (its hash's; others may share it), in words of 64; None without contexts.

    Tasks set the bits and Spark joins them, so what reaches the driver has at most ``FILTER_BITS`` / 64 rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bit = np.unique(_bits(b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)))
                word, first = np.unique(bit >> np.uint64(6), return_index=True)
                ones = np.bitwise_or.reduceat(np.uint64(1) << (bit & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(ones.view(np.int64))], ["word", "bits"])
    contexts = tail.select("level", F.expr(CONTEXT).alias("context"))
    found = contexts.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    if not len(found):
        return None
    out = np.zeros(FILTER_BITS >> 6, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _levels(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    """Contexts, their counts and numbers of symbols, row keys and counts of each level of a tree's rows."""
    level, key, n = (table.column(c).to_numpy() for c in ("level", "key", "n"))
    for k in range(DEPTH + 1):
        own = np.flatnonzero(level == k)
        rows = key[own].view(np.uint64)
        own, rows = own[np.argsort(rows)], np.sort(rows)
        contexts, at, symbols = np.unique(rows & np.uint64((1 << 8 * k) - 1), return_inverse=True, return_counts=True)
        yield contexts, np.bincount(at, n[own], len(contexts)), symbols, rows, n[own]


def _collected(tree: DataFrame) -> Iterator[tuple[np.ndarray, ...]]:
    """The same from a frame.  Small levels come together; of a large one first the contexts, then the rows in pieces of
    ``PIECE_ROWS`` or one symbol, so that the driver holds little beside what it keeps."""
    symbol = F.expr("cast(shiftrightunsigned(key, 8 * level) AS int)")
    sizes: dict[int, dict[int, int]] = {k: {} for k in range(DEPTH + 1)}
    largest = dict.fromkeys(sizes, 0)
    for r in tree.groupBy("level", symbol.alias("symbol")).agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).collect():     # one for each level and byte
        sizes[r["level"]][r["symbol"]] = r["rows"]
        largest[r["level"]] = max(largest[r["level"]], r["most"])
    small = [k for k in sizes if sum(sizes[k].values()) <= PIECE_ROWS // 2]
    together = list(_levels(tree.where(F.col("level").isin(small)).select("level", "key", "n").toArrow()))
    for k in sizes:
        if k in small:
            yield together[k]
            continue
        own = tree.where(F.col("level") == k)
        about = own.select(F.expr(CONTEXT).alias("context"), "n_context", "symbols").distinct().toArrow()
        contexts = about.column("context").to_numpy().view(np.uint64)
        order = np.argsort(contexts)
        pieces, held = [0], 0
        for c in range(256):
            if held and held + sizes[k].get(c, 0) > PIECE_ROWS:
                pieces.append(c)
                held = 0
            held += sizes[k].get(c, 0)
        keys = np.empty(sum(sizes[k].values()), np.uint64)
        n = np.empty(len(keys), np.float32 if largest[k] < EXACT else np.float64)
        done = 0
        for low, high in zip(pieces, [*pieces[1:], 256]):       # the symbol is a key's highest byte, so pieces follow each other
            rows = own.where(symbol.between(low, high - 1)).select("key", "n").toArrow()
            key = rows.column("key").to_numpy().view(np.uint64)
            at = np.argsort(key)
            keys[done:done + len(at)], n[done:done + len(at)] = key[at], rows.column("n").to_numpy()[at]
            done += len(at)
            del rows, key, at
            pa.default_memory_pool().release_unused()
        yield contexts[order], about.column("n_context").to_numpy()[order], about.column("symbols").to_numpy()[order], keys, n


class Tree:
    """Contexts by length, as sorted arrays.  ``beyond`` is the filter of contexts that are not here."""

    def __init__(self, rows: pa.Table | DataFrame, beyond: np.ndarray | None = None):
        self.levels, self.beyond, self.of = [], beyond, []
        for contexts, total, symbols, key, n in _levels(rows) if isinstance(rows, pa.Table) else _collected(rows):
            self.levels.append((contexts, total.astype(np.uint32 if not len(total) or total.max() < 1 << 32 else np.float64), symbols.astype(np.uint16), key, n.astype(np.float32 if not len(n) or n.max() < EXACT else np.float64, copy=False)))
        root = np.zeros(256)
        root[self.levels[0][3].astype(np.int64)] = self.levels[0][4]
        self.root = (root + 1) / (root.sum() + 256)

    def places(self) -> list[np.ndarray]:
        """Each row's context, by level; found where the tree is used, as it need not travel."""
        if not self.of:
            for k, (contexts, _, _, rows, _) in enumerate(self.levels):
                of = np.empty(len(rows), np.int32)
                for i in range(0, len(rows), PIECE_ROWS):
                    of[i:i + PIECE_ROWS] = np.searchsorted(contexts, rows[i:i + PIECE_ROWS] & np.uint64((1 << 8 * k) - 1))
                self.of.append(of)
        return self.of

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Probability of the symbol of each key (of ``grams``) after the longest suffix of its context."""
        distinct, same = np.unique(by_symbol(keys), return_inverse=True)
        return self.walk(distinct)[0][same]

    def walk(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted distinct keys with the symbol first: its probability after the longest suffix of the
        context that is here, that suffix's length, and whether it may go on beyond this tree.

        Keys of a common symbol and suffix stand together, so each level looks up its own distinct ones only.
        """
        if not len(keys):
            return np.zeros(0), np.zeros(0, np.int32), np.zeros(0, bool)
        p, kept, depth = np.ones(1), np.ones(1, bool), np.zeros(1, np.int32)
        group = np.zeros(len(keys), np.int32)           # each key's place among the distinct ones of a level
        for k, ((contexts, total, symbols, rows, n), of) in enumerate(zip(self.levels, self.places())):
            part = keys >> np.uint64(8 * (DEPTH - k))
            new = np.append(True, part[1:] != part[:-1])
            first = np.flatnonzero(new)
            own, above = part[first], group[first]
            group = np.cumsum(new, dtype=np.int32) - np.int32(1)
            p, kept, depth = p[above], kept[above], depth[above]
            if k == 0:
                p = self.root[own.astype(np.int64)]
                continue
            if not len(contexts):
                kept[:] = False
                continue
            live = np.flatnonzero(kept)
            own = own[live]
            row = np.minimum(np.searchsorted(rows, own), len(rows) - 1)     # both are sorted
            met = rows[row] == own
            at, seen = of[row], np.where(met, n[row], 0.0)
            rest = np.flatnonzero(~met)                 # a context may be here without the symbol
            context = own[rest] & np.uint64((1 << 8 * k) - 1)
            place = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            gone = contexts[place] != context
            at[rest] = place
            kept[live[rest[gone]]] = False
            here = np.ones(len(live), bool)
            here[rest[gone]] = False
            live, at, seen = live[here], at[here], seen[here]
            pull = PULL * symbols[at]
            p[live] = (seen + pull * p[live]) / (total[at] + pull)
            depth[live] = k
        more = np.zeros(len(keys), bool)
        if self.beyond is not None:
            out = np.flatnonzero(depth < DEPTH)
            next_level = depth[out].astype(np.uint64) + np.uint64(1)
            context = keys[out] >> np.uint64(8) * (np.uint64(DEPTH) - next_level) & (np.uint64(1) << np.uint64(8) * next_level) - np.uint64(1)
            bit = _bits(next_level, context)
            more[out] = self.beyond[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
        return p, depth, more


def rare_grams(parts: DataFrame, tail: DataFrame, model) -> DataFrame:
    """key, value: logarithm of the probability of every gram that leaves the broadcast tree, by the contexts of ``tail``."""
    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = model.value[0]
        for b in batches:
            keys = np.sort(b.column(0).to_numpy().view(np.uint64))
            p, depth, _ = tree.walk(keys)
            for k in range(1, DEPTH + 1):
                at = np.flatnonzero(depth < k)
                own = keys[at] >> np.uint64(8 * (DEPTH - k))
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys[at].view(np.int64)), pa.array(p[at]), pa.array(np.full(len(at), k, np.int32)),
                    pa.array((own & np.uint64((1 << 8 * k) - 1)).view(np.int64)), pa.array((own >> np.uint64(8 * k)).astype(np.int32))],
                    ["key", "p", "level", "context", "symbol"])
    grams_out = parts.where(F.col("kind") == GRAM).select("key").distinct().mapInArrow(chains, "key long, p double, level int, context long, symbol int")
    symbol = F.expr("cast(shiftrightunsigned(key, 8 * level) as int)")
    contexts = tail.groupBy("level", F.expr(CONTEXT).alias("context"), "n_context", "symbols").agg(F.map_from_entries(F.collect_list(F.struct(symbol, "n"))).alias("seen"))
    step = F.when(F.col("n_context").isNotNull(), F.struct(
        "level", F.coalesce(F.expr("seen[symbol]"), F.lit(0)).cast("double").alias("n"), F.col("n_context").cast("double").alias("total"), (PULL * F.col("symbols")).alias("pull")))
    return grams_out.join(contexts, ["level", "context"], "left").groupBy("key").agg(F.first("p").alias("p"), F.array_sort(F.collect_list(step)).alias("steps")) \
        .select("key", F.log10(F.expr("aggregate(steps, p, (q, x) -> (x.n + x.pull * q) / (x.total + x.pull))")).alias("value"))


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and tree scores of every row of ``df``, learnt from those where ``held_out``
    (a Column over doc_id) is false."""
    spark = df.sparkSession
    docs = id_and_text(df, id_col, text_col).withColumn("held_out", held_out)
    reduced = materialize(_reduced(_counted(docs.where(~F.col("held_out")), _buckets(spark))), "counts")
    words = reduced.where(F.col("kind") == WORD)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(1.0, total / HEAD)
    head = words.where(F.col("n") >= least).select("key", "n").toArrow()
    head_keys, head_n = head.column("key").to_numpy(), head.column("n").to_numpy()
    order = np.argsort(head_keys)
    head_keys, head_n = head_keys[order], head_n[order]
    del head, order
    tree = materialize(_tree(reduced), "tree")
    often = (F.col("n_context") >= head_times(tree)) | (F.col("level") == 0)
    tail, top = tree.where(~often), tree.where(often)
    beyond = tail_filter(tail)
    whole = Tree(top, beyond)
    model = spark.sparkContext.broadcast((whole, head_keys, head_n))
    whole.levels = []       # the tasks read what was broadcast; the driver needs its own copy no more
    schema = ("kind int, key long, row long, times long, info struct<doc_id: long, held_out: boolean, n_tokens: long, "
              "known: long, log_sum: double, score: double>")
    about = pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("log_sum", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, times = model.value
        row = TaskContext.get().partitionId() << 40
        for b in gathered(batches, 1, AT_ONCE):
            data, offsets = buffers(b.column(1))
            for at, d, o in chunks(data, offsets, AT_ONCE):
                low, n = LOWER[d], len(o) - 1
                starts, ends, first = spans(low, o, SPACED)
                # the tree's score: sort the grams, look each distinct one up once
                symbols, so = streams(low, o, starts, ends, first)
                gram = by_symbol(grams(symbols, so))
                order = np.argsort(gram)
                gram, owner = gram[order], np.repeat(np.arange(n, dtype=np.int32), np.diff(so))[order]
                del order, symbols
                new = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
                p, _, more = tree.walk(gram[new])
                many = np.diff(np.append(new, len(gram)))
                tree_score = np.bincount(owner, np.repeat(np.where(more, 0.0, np.log10(p)), many), n)
                if more.any():                 # the contexts beyond the broadcast ones, by a join
                    out = np.repeat(more, many)
                    distinct, same = np.unique(gram[out], return_inverse=True)
                    pair, many = np.unique(owner[out].astype(np.int64) * len(distinct) + same, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), GRAM, np.int32)), pa.array(distinct[pair % len(distinct)].view(np.int64)),
                                                      pa.array(row + 2 * (pair // len(distinct))), pa.array(many, pa.int64()), pa.nulls(len(pair), about)], NAMES)
                # unigrams: the head here, the rest by a join
                doc = np.append(np.repeat(np.arange(n), np.diff(first)), np.arange(n))
                word, same = np.unique(np.append(word_keys(low, starts, ends), np.full(n, END_TOKEN)), return_inverse=True)
                place = np.minimum(np.searchsorted(keys, word), max(len(keys) - 1, 0))
                found = keys[place] == word if len(keys) else np.zeros(len(word), bool)
                value = np.zeros(len(word))
                value[found] = np.log10(times[place[found]] + 1.0)
                log_sum, known = np.bincount(doc, value[same], n), np.bincount(doc, found[same], n).astype(np.int64)
                rest = ~found[same]
                pair, many = np.unique(doc[rest] * len(word) + same[rest], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), WORD, np.int32)), pa.array(word[pair % len(word)]), pa.array(row + 2 * (pair // len(word))), pa.array(many, pa.int64()), pa.nulls(len(pair), about)], NAMES)
                info = pa.StructArray.from_arrays([b.column(0).slice(at, n), b.column(2).slice(at, n), pa.array(np.diff(first) + 1, pa.int64()), pa.array(known), pa.array(log_sum), pa.array(tree_score)], fields=list(about))
                own = row + 2 * np.arange(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, DOC, np.int32)), pa.array(own), pa.array(own), pa.array(np.zeros(n, np.int64)), info], NAMES)
                row += 2 * n
    short_batches(spark)
    parts = docs.select("doc_id", "text", "held_out").mapInArrow(run, schema)
    rare = words.where(F.col("n") < least).select("kind", "key", F.log10(F.col("n") + 1.0).alias("value"))
    if beyond is not None:
        parts = materialize(parts, "parts")
        rare = rare.union(rare_grams(parts, tail, model).select(F.lit(GRAM).alias("kind"), "key", "value"))
    met = parts.join(rare, ["kind", "key"], "left")
    word, gram = F.col("kind") == WORD, F.col("kind") == GRAM
    each = met.groupBy("row").agg(
        *[F.max(f"info.{c}").alias(c) for c in ("doc_id", "held_out", "n_tokens")],
        (F.sum(F.coalesce("info.known", F.lit(0))) + F.sum(F.when(word & F.col("value").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        (F.sum(F.coalesce("info.log_sum", F.lit(0.0))) + F.sum(F.when(word & F.col("value").isNotNull(), F.col("times") * F.col("value")).otherwise(0.0))).alias("log_sum"),
        (F.max("info.score") + F.sum(F.when(gram, F.col("times") * F.col("value")).otherwise(0.0))).alias("score"))
    return each.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"),
                       (F.col("log_sum") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"), "score")
