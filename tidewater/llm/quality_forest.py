"""Quality rules with an isolation forest on rule statistics.

Rule statistics are computed for whole batches on the UTF-8 bytes.  The base
rules reject a document outright; for the others the verdict is the forest's:
trees of random splits are grown over a bounded sample of labelled good rows,
inside the box that all labelled rows span, and the mean path length gives the
anomaly score.  (Splits are drawn in a node's box, not only between its own
points, so a document in a region without good rows ends in an empty leaf after
a few splits.)  The threshold is calibrated on the score histograms of all
labelled rows, good and bad: of those that lose at most ``max_loss`` of the good rows, the one
with the least cost, which is the share of bad rows kept and ``LOSS_WEIGHT`` times the share of good ones lost.

Defined results: null or empty text has no words and fails the base rules;
labels with a null id or null quality are left out; a row labelled more than
once counts each time; without labelled good rows there is no forest and the
base rules decide alone; rows are judged one by one, so repeated rows are judged
alike; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, id_and_text, keep_rows, map_batches
from tidewater.llm.text import SPACED, buffers, chunks, mix, shingles, spans, word_hashes
from tidewater.session import materialize

TRAIN_ROWS = 20_000      # bound of the labelled sample that the trees are grown on
TREES, ROWS_PER_TREE, DEPTH = 200, 256, 12
MAX_LOSS = 0.005         # labelled good rows that the threshold may lose
LOSS_WEIGHT = 10.0       # a good row lost is as bad as so many bad ones kept (as shares)
BINS = 2000
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
PRIOR = 20               # usual words added to each text when shares are taken
FEATURES = ("word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks",
            "variety", "line_upper", "line_marks", "line_symbols", "long_words")

_CLASS = np.zeros((256, 5), bool)                     # symbol, upper, letter, digit, mark
_CLASS[[ord(c) for c in "#*$%&|<>"], 0] = True
_CLASS[65:91, 1] = True
_CLASS[65:91, 2] = _CLASS[97:123, 2] = True
_CLASS[48:58, 3] = True
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()], 4] = True
_CLASS = np.ascontiguousarray(_CLASS.T)


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])


def _max_by_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n)
    np.maximum.at(out, doc, values)
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once, and (second row) which have an earlier equal one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros((2, len(keys)), bool)
    out[0, order[1:][same]] = out[0, order[:-1][same]] = out[1, order[1:][same]] = True
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base statistics (long) and features (double) of a run of documents, one row each."""
    n = len(offsets) - 1
    doc_key = mix(np.arange(1, n + 1, dtype=np.uint64))
    starts, ends, first = spans(data, offsets, SPACED)
    hashes = word_hashes(data, starts, ends)
    n_words = np.diff(first)
    lead = (data & 0xC0) != 0x80
    word_chars = _sums(SPACED[data] & lead, offsets) if len(data) else np.zeros(n, np.int64)
    symbol, upper, letter, digit, mark = (_CLASS[i][data] for i in range(5))

    # words in 5-word windows that occur twice or more
    sh, off = shingles(hashes, first, 5)
    doc = np.repeat(np.arange(n), np.diff(off))
    full = n_words[doc] >= 5
    at = (first[doc] + np.arange(len(sh)) - off[doc])[full]
    twice = _repeated(mix(sh[full] ^ doc_key[doc[full]]))[0] if len(at) else np.zeros((0,), bool)
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 5, -1)
    n_repeat = _sums(np.cumsum(cover)[:-1] > 0, first)

    # lines: equal to an earlier one, and the most shouting or most marked line
    ends_line = np.flatnonzero(data == 0x0A)
    line_start = np.sort(np.concatenate((offsets[:-1], ends_line + 1)), kind="stable")
    line_doc = np.searchsorted(offsets[1:], line_start, side="right")     # empty lines may fall to the next text: they hold no word
    line_end = np.append(line_start[1:], len(data))
    stop = line_end - ((line_end > line_start) & (line_end > 0) & (data[np.maximum(line_end - 1, 0)] == 0x0A)) if len(data) else line_end
    words_in = np.searchsorted(starts, line_end) - np.searchsorted(starts, line_start)
    some = words_in > 0
    ls, le, ld, lw = line_start[some], stop[some], line_doc[some], words_in[some]
    n_dup = np.zeros(n, np.int64)
    if len(ls):
        np.add.at(n_dup, ld[_repeated(mix(word_hashes(data, ls, le) ^ doc_key[ld]))[1]], 1)

    def in_line(mask):
        c = np.concatenate(([0], np.cumsum(mask)))
        return c[le] - c[ls]
    words = np.maximum(n_words, 1)
    chars = np.maximum(_sums(lead, offsets) if len(data) else np.zeros(n), 1)
    letters = _sums(letter, offsets)
    wordy = np.minimum(lw / 8.0, 1.0) if len(ls) else np.zeros(0)      # a short line weighs less
    distinct = np.maximum(n_words - np.bincount(np.repeat(np.arange(n), n_words)[_repeated(mix(hashes ^ np.repeat(doc_key, n_words)))[1]], minlength=n), 1) if len(hashes) else np.ones(n)
    # shares are shrunk as if PRIOR usual words stood before the text: in a short text one mark says little
    some_words = words + PRIOR

    def in_lines(mask, per):
        return _max_by_doc(np.minimum(in_line(mask) / np.maximum(per, 1), 3) * wordy, ld, n) if len(ls) else np.zeros(n)
    features = np.column_stack([
        np.minimum((word_chars + 5 * PRIOR) / some_words, 40), np.minimum(_sums(symbol, offsets) / some_words, 2),
        n_dup / (_sums(data == 0x0A, offsets) + 6), n_repeat / some_words,
        _sums(upper, offsets) / (letters + 5 * PRIOR), _sums(digit, offsets) / (chars + 5 * PRIOR),
        np.minimum(_sums(mark, offsets) / some_words, 3), np.log1p(distinct + PRIOR) / np.log1p(some_words),
        in_lines(upper, in_line(letter) if len(ls) else None), in_lines(mark, lw), in_lines(symbol, lw),
        np.minimum(_sums((ends - starts) > 30, first) / some_words, 1) if len(starts) else np.zeros(n)])
    base = np.column_stack([n_words, word_chars, _sums(symbol, offsets), n_dup, n_repeat]).astype(np.int64)
    return base, features


def batch_statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(texts)
    parts = [statistics(d, o) for _, d, o in chunks(data, offsets)]
    if not parts:
        return np.zeros((0, len(BASE)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PCT * base[:, 0])


# ---------------------------------------------------------------- forest
@dataclass
class Forest:
    """Trees as flat arrays: split feature (-1: leaf), split value, left child (right is next), leaf path length."""
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    norm: float
    threshold: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 to the minus mean path length over the expected one."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(self.feature.shape[0]):
            node = np.zeros(len(x), np.int64)
            live = rows
            while len(live):
                f = self.feature[t, node[live]]
                live, f = live[f >= 0], f[f >= 0]
                at = node[live]
                node[live] = self.left[t, at] + (x[live, f] >= self.value[t, at])
            total += self.path[t, node]
        return 2.0 ** (-total / max(self.feature.shape[0], 1) / self.norm)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def grow(sample: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE,
         depth: int = DEPTH, seed: int = 7) -> Forest:
    """Isolation trees over random subsamples; splits are drawn uniformly inside each node's box."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(sample))
    size = 2 ** (depth + 1)
    feature, value = np.full((trees, size), -1, np.int64), np.zeros((trees, size))
    left, path = np.zeros((trees, size), np.int64), np.zeros((trees, size))
    wide, most = np.flatnonzero(high > low), 1
    for t in range(trees):
        pick = sample[rng.choice(len(sample), rows, replace=False)]
        todo, used = [(0, np.arange(rows), low.copy(), high.copy(), 0)], 1
        while todo:
            node, own, lo, hi, d = todo.pop()
            if d >= depth or len(own) <= 1 or not len(wide):
                path[t, node] = d + _expected(len(own))
                continue
            f = int(rng.choice(wide))
            cut = rng.uniform(lo[f], hi[f])
            right = pick[own, f] >= cut
            feature[t, node], value[t, node], left[t, node] = f, cut, used
            lo_r, hi_l = lo.copy(), hi.copy()
            lo_r[f] = hi_l[f] = cut
            todo += [(used, own[~right], lo, hi_l, d + 1), (used + 1, own[right], lo_r, hi, d + 1)]
            used += 2
        most = max(most, used)
    # every worker holds a copy: only the nodes in use, in narrow types
    return Forest(feature[:, :most].astype(np.int16), value[:, :most].copy(), left[:, :most].astype(np.int32),
                  path[:, :most].astype(np.float32), max(_expected(rows), 1.0))


def statistics_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, base statistics and the feature vector of every row."""
    def run(b: pa.RecordBatch) -> pa.Table:
        base, x = batch_statistics(b.column(1))
        cols = {"doc_id": b.column(0)} | {name: base[:, i] for i, name in enumerate(BASE)}
        return pa.table(cols | {"features": pa.FixedSizeListArray.from_arrays(x.reshape(-1), len(FEATURES)).cast(pa.list_(pa.float64()))})
    return map_batches(id_and_text(df, id_col, text_col), run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", features array<double>")


def fit(stats: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", train_rows: int = TRAIN_ROWS,
        max_loss: float = MAX_LOSS) -> Forest | None:
    """Grow the trees on a bounded sample of good rows and calibrate the threshold on all labelled rows.

    ``good`` is a Column over ``labels``.  Only the sample, two rows of bounds and
    two histograms of ``BINS`` bins reach the driver.
    """
    marked = labels.select(col(id_col).cast("long").alias("label_id"), good.cast("boolean").alias("good")).where("label_id IS NOT NULL AND good IS NOT NULL")
    rows = materialize(stats.join(marked, stats.doc_id == marked.label_id).select(
        "doc_id", "good", "features", ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("failed")), "labelled")
    passed = rows.where(~F.col("failed"))
    # a sample by hash: about train_rows of them, cut to train_rows, so that little reaches the last sort
    share = min(1.0, 1.1 * train_rows / max(passed.where("good").count(), 1))
    drawn = passed.where("good").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = [r.features for r in drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("features").collect()]
    if len(sample) < 2:
        return None
    k = len(FEATURES)
    ends = passed.agg(*[F.min(F.col("features")[i]).alias(f"l{i}") for i in range(k)], *[F.max(F.col("features")[i]).alias(f"h{i}") for i in range(k)]).first()
    forest = grow(np.array(sample), np.array(ends[:k]), np.array(ends[k:]))

    def score(b: pa.RecordBatch) -> pa.Table:
        s = forest.scores(_matrix(b.column(1)))
        return pa.table({"good": b.column(0), "bin": np.minimum((s * BINS).astype(np.int64), BINS - 1)})
    hist = map_batches(passed.select("good", "features"), score, "good boolean, bin long").groupBy("good", "bin").count().collect()
    counts = np.zeros((2, BINS))
    for r in hist:
        counts[int(r["good"]), r["bin"]] = r["count"]
    forest.threshold = threshold(counts[1], counts[0], max_loss)
    return forest


def threshold(good: np.ndarray, bad: np.ndarray, max_loss: float = MAX_LOSS) -> float:
    """Score from which a document is rejected, the upper end of a bin of the two histograms.

    Without bad rows it is the lowest that loses at most ``max_loss`` of the good ones."""
    lost = (good.sum() - np.cumsum(good)) / max(good.sum(), 1)
    kept = np.cumsum(bad) / max(bad.sum(), 1)
    allowed = lost <= max_loss
    cost = np.where(allowed, kept + LOSS_WEIGHT * lost, np.inf) if bad.sum() else np.where(allowed, -lost, np.inf)
    best = np.flatnonzero(cost <= cost.min() + 1e-12)       # the highest of equals rejects least; without bad rows the lowest
    return (int(best[-1] if bad.sum() else best[0]) + 1) / len(good)


def _matrix(features: pa.Array) -> np.ndarray:
    return features.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def judge(df: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base verdict, anomaly score and final verdict of every row of ``df``."""
    stats = materialize(statistics_table(df, id_col, text_col), "quality-stats")
    forest = fit(stats, labels, good)

    def run(b: pa.RecordBatch) -> pa.Table:
        base = np.column_stack([b.column(1 + i).to_numpy() for i in range(len(BASE))])
        x = _matrix(b.column(1 + len(BASE)))
        failed = base_failed(base)
        s = forest.scores(x) if forest else np.zeros(len(x))
        ok = ~failed & (s < forest.threshold if forest else True)
        return pa.table({"doc_id": b.column(0)} | {c: base[:, i] for i, c in enumerate(BASE)} | {"base_failed": failed, "kept": ok, "anomaly": s})
    return map_batches(stats, run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, anomaly double")


def keep(df: DataFrame, labels: DataFrame, good, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules and the forest keep, with all their columns."""
    stats = materialize(statistics_table(df, id_col, text_col), "quality-stats")
    forest = fit(stats, labels, good)

    def verdict(texts: pa.Array) -> np.ndarray:
        base, x = batch_statistics(texts)
        return ~base_failed(base) & (forest.scores(x) < forest.threshold if forest else True)
    return keep_rows(df, text_col, verdict)
