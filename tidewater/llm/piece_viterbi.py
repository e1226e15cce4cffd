"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is normalised (blanks become the word mark, one stands before the text)
and cut before each run of marks; no piece reaches over such a cut, so each word
has its own best path, and equal words of a batch share one.  Words of equal
length advance together: for all of them at once the hash of every substring
is taken from prefix sums and probed in the sorted keys of the pieces of that
length, and a maximum over the lengths stores score and backpointer at each
position.

Piece scores are the stored ones of a unigram model.  A merge (BPE) model stores
merge ranks instead; they are read as Zipf log probabilities, -ln(rank * H),
so that the search still finds the most probable segmentation of its pieces.
Characters without a piece fall back to byte pieces; among paths of equal score
the one with the longest last piece is taken.

Decoding joins the pieces' bytes, turns marks into blanks and drops the first.
It gives back the text, byte for byte, but for the mark character itself
(U+2581), which reads as a blank, as in the library.

Defined results: null and empty text have no pieces and decode to the empty
text; repeated rows give repeated rows; texts and words may be of any length
(positions are probed in blocks); an empty table gives an empty table; other
columns are not carried.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tidewater.llm.common import id_and_text, map_batches, short_batches
from tidewater.llm.text import buffers, chunks, word_hashes

MARK = "▁"
UNKNOWN_PENALTY = 10.0          # below the least score, for a character without a piece
CELLS = 1 << 21                 # positions x words handled at once
_B = 0x5851F42D4C957F2D         # odd, so it has an inverse modulo 2^64
_B_INV = pow(_B, -1, 1 << 64)
_BLANK = 0x20
BITS = 18


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p)        # wraps modulo 2^64


class Pieces:
    """The vocabulary of a model file, ready for probing and for decoding."""

    def __init__(self, path: str, scores: str = "stored"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.byte_ids = np.full(256, -1, np.int64)
        plain = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                plain.append((i, piece))
        self.unknown_id = sp.unk_id()
        if scores == "zipf":
            weight = 1.0 / np.arange(1, len(plain) + 1)
            value = np.log(weight / weight.sum())
        else:
            value = np.array([sp.get_score(i) for i, _ in plain])
        self.unknown_score = float(value.min()) - UNKNOWN_PENALTY
        self.longest = max(len(p) for _, p in plain)
        self.by_length: dict[int, tuple] = {}
        for length in range(1, self.longest + 1):
            own = [(k, i, p.replace(MARK, " ")) for k, (i, p) in enumerate(plain) if len(p) == length]
            if not own:
                continue
            codes = np.array([[ord(c) for c in p] for _, _, p in own], np.uint64)
            key = (codes * _powers(_B, length)).sum(axis=1, dtype=np.uint64)
            order = np.argsort(key)
            key = key[order]
            if (key[1:] == key[:-1]).any():
                raise ValueError("two pieces share a key")
            maybe = np.zeros(1 << BITS, bool)
            maybe[(key >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.by_length[length] = key, np.array([i for _, i, _ in own])[order], value[[k for k, _, _ in own]][order], maybe
        sizes = np.array([len(b) for b in self.bytes_of])
        self.byte_offsets = np.concatenate(([0], np.cumsum(sizes)))
        self.byte_data = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    # ------------------------------------------------------------ search
    def best_paths(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best segmentations of words of equal length: ``codes`` has a column for each word.

        Returns the piece that ends at each position (-1: a character without a
        piece), its length, and the words' scores.
        """
        length, n = codes.shape
        reach = min(self.longest, length)
        sums = np.zeros((length + 1, n), np.uint64)
        np.cumsum(codes * _powers(_B, length)[:, None], axis=0, out=sums[1:])
        inverse = _powers(_B_INV, length + 1)
        best = np.zeros((length + 1, n))
        back = np.ones((length + 1, n), np.uint8 if self.longest < 256 else np.uint16)
        piece = np.full((length + 1, n), -1, np.int32)
        block = max(1, CELLS // max(n * reach, 1))
        for a in range(1, length + 1, block):
            b = min(a + block, length + 1)
            found = []
            for size in range(1, reach + 1):
                lo = max(a, size)
                if size not in self.by_length or lo >= b:
                    continue
                key, ids, value, maybe = self.by_length[size]
                sub = (sums[lo:b] - sums[lo - size:b - size]) * inverse[lo - size:b - size, None]
                at = np.flatnonzero(maybe[(sub >> np.uint64(64 - BITS)).astype(np.int64)])
                probe = sub.reshape(-1)[at]
                place = np.minimum(np.searchsorted(key, probe), len(key) - 1)
                hit = key[place] == probe
                at, place = at[hit], place[hit]
                if len(at):
                    row = at // n
                    found.append((size, lo, np.searchsorted(row, np.arange(b - lo + 1)), at - row * n, place))
            for e in range(a, b):
                here = best[e - 1] + self.unknown_score
                for size, lo, starts, who, place in found:
                    if e < lo:
                        continue
                    s = slice(starts[e - lo], starts[e - lo + 1])
                    if s.start == s.stop:
                        continue
                    w, (_, ids, value, _) = who[s], self.by_length[size]
                    score = best[e - size, w] + value[place[s]]
                    better = score >= here[w]
                    w = w[better]
                    here[w] = score[better]
                    back[e, w] = size
                    piece[e, w] = ids[place[s][better]]
                best[e] = here
        return piece, back, best[length]

    def segment(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (all words', one after the other), offsets by word, and scores."""
        first = np.concatenate(([0], np.cumsum(lengths)))
        n_words = len(lengths)
        who, place, ids = [], [], []
        score = np.zeros(n_words)
        for length in np.unique(lengths):
            same = np.flatnonzero(lengths == length)
            step = max(1, CELLS // int(length * min(length, self.longest)))
            for a in range(0, len(same), step):
                own = same[a:a + step]
                piece, back, score[own] = self.best_paths(codes[first[own][None, :] + np.arange(length)[:, None]].astype(np.uint64))
                at, col = np.full(len(own), length), np.arange(len(own))
                while len(col):                       # all words walk back together
                    p, size = piece[at, col], back[at, col].astype(np.int64)
                    who.append(own[col])
                    ids.append(np.where(p >= 0, p, -1 - codes[first[own[col]] + at - 1].astype(np.int64)))
                    at = at - size
                    place.append(at)
                    live = at > 0
                    at, col = at[live], col[live]
        if not who:
            return np.zeros(0, np.int64), np.zeros(n_words + 1, np.int64), score
        who, place, ids = np.concatenate(who), np.concatenate(place), np.concatenate(ids)
        order = np.argsort(first[who] + place)        # places are distinct
        who, ids = who[order], ids[order]
        if (ids < 0).any():
            who, ids = self._fall_back(who, ids)
        return ids, np.searchsorted(who, np.arange(n_words + 1)), score

    def _fall_back(self, who: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters without a piece (-1 - code point) by their byte pieces."""
        code = np.where(ids < 0, -1 - ids, 0)
        if (self.byte_ids < 0).any():                 # a model without byte pieces: unknown
            return who, np.where(ids < 0, self.unknown_id, ids)
        size = np.where(ids >= 0, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        at = np.repeat(np.cumsum(size) - size, size)
        k = np.arange(size.sum()) - at                # which byte of its character
        size_, code_, ids_ = (np.repeat(x, size) for x in (size, code, ids))
        shift = 6 * (size_ - 1 - k)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size_] | (code_ >> shift)
        byte = np.where(size_ == 1, code_, np.where(k == 0, lead, 0x80 | ((code_ >> shift) & 0x3F)))
        return np.repeat(who, size), np.where(ids_ >= 0, ids_, self.byte_ids[byte & 0xFF])

    # ------------------------------------------------------------ batches
    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of normalised documents, offsets by document, and scores."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(n + 1, np.int64), np.zeros(n)
        blank = data == _BLANK
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        begin = offsets[:-1][np.diff(offsets) > 0]
        start[begin] = True
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(data))
        _, one, same = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        size = (ends - starts)[one]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        raw = data[np.repeat(starts[one], size) + within]
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        lengths = np.diff(np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[np.concatenate(([0], np.cumsum(size)))])
        ids, at, score = self.segment(codes, lengths)
        count = np.diff(at)[same]
        word0 = np.searchsorted(starts, offsets)
        token0 = np.concatenate(([0], np.cumsum(count)))
        out = ids[np.repeat(at[same], count) + np.arange(token0[-1]) - np.repeat(token0[:-1], count)]
        total = np.concatenate(([0.0], np.cumsum(score[same])))
        return out, token0[word0], total[word0[1:]] - total[word0[:-1]]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the documents that the ids spell, the first blank of each dropped."""
        size = np.diff(self.byte_offsets)[ids]
        end = np.concatenate(([0], np.cumsum(size)))
        raw = self.byte_data[np.repeat(self.byte_offsets[:-1][ids], size) + np.arange(end[-1]) - np.repeat(end[:-1], size)]
        start = end[offsets]
        some = start[:-1][np.diff(start) > 0]
        drop = some[raw[some] == _BLANK]
        gone = np.zeros(len(raw) + 1, np.int64)
        gone[drop + 1] = 1
        return np.delete(raw, drop), start - np.cumsum(gone)[start]


@lru_cache(maxsize=2)
def vocabulary(path: str, scores: str) -> Pieces:
    return Pieces(path, scores)


def normalise(texts: pa.Array) -> pa.Array:
    """Marks read as blanks, and one blank before each text that is not empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
    return pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))


def encode_texts(texts: pa.Array, pieces: Pieces):
    """(first document, ids, offsets, scores, normalised bytes and offsets) of runs of documents."""
    data, offsets = buffers(normalise(texts))
    for at, d, o in chunks(data, offsets, 1 << 21):
        yield at, *pieces.encode(d, o), d, o


def encode(df: DataFrame, path: str, scores: str = "stored", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every row."""
    def run(b: pa.RecordBatch) -> pa.Table:
        ids = [pa.array(np.split(i.astype(np.int32), o[1:-1]), pa.list_(pa.int32())) for _, i, o, *_ in encode_texts(b.column(1), vocabulary(path, scores))]
        return pa.table({"doc_id": b.column(0), "ids": pa.chunked_array(ids)})
    return map_batches(id_and_text(df, id_col, text_col), run, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids decode to the empty text."""
    from pyspark.sql import functions as F
    from tidewater.llm.common import col

    def run(b: pa.RecordBatch) -> pa.Table:
        v, lists = vocabulary(path, "stored"), b.column(1)
        size = np.array([len(x) for x in lists])
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        raw, at = v.decode(flat, np.concatenate(([0], np.cumsum(size))))
        return pa.table({"doc_id": b.column(0), "text": [raw[at[i]:at[i + 1]].tobytes().decode(errors="replace") for i in range(len(size))]})
    rows = df.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return map_batches(rows, run, "doc_id long, text string")


def check(df: DataFrame, path: str, scores: str = "stored", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text encoded and decoded again: n_pieces, n_byte_pieces, ids_crc32, score, round_trip."""
    def run(b: pa.RecordBatch) -> pa.Table:
        v, n = vocabulary(path, scores), b.num_rows
        count, by_byte, crc, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        same = np.zeros(n, bool)
        is_byte = np.isin(np.arange(len(v.bytes_of)), v.byte_ids)
        given, given_at = buffers(pc.replace_substring(b.column(1).cast(pa.large_string()), MARK, " "))
        for at, ids, o, score, *_ in encode_texts(b.column(1), v):
            k = len(o) - 1
            count[at:at + k] = np.diff(o)
            by_byte[at:at + k] = np.diff(np.concatenate(([0], np.cumsum(is_byte[ids])))[o])
            total[at:at + k] = score
            small, (raw, raw_at) = ids.astype("<u4"), v.decode(ids, o)
            for d in range(k):
                crc[at + d] = zlib.crc32(small[o[d]:o[d + 1]])
                same[at + d] = np.array_equal(raw[raw_at[d]:raw_at[d + 1]], given[given_at[at + d]:given_at[at + d + 1]])
        return pa.table({"doc_id": b.column(0), "n_pieces": count, "n_byte_pieces": by_byte, "ids_crc32": crc, "score": total, "round_trip": same})
    out = map_batches(id_and_text(df, id_col, text_col), run, "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, score double, round_trip boolean")
    short_batches(df.sparkSession)
    return out
