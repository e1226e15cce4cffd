"""Token counts through a digest cache.

Content is normalised (null reads as empty) and digested; the digest, together
with a digest of the tokenizer file, its library and its version, is the key of
a stored count.  Keys are joined to the cache; only distinct misses are encoded,
once each, and appended.  A change of tokenizer changes the version digest, so
old counts can never be read for it.

Texts move only for misses: the first pass shuffles digests alone.  One row is
chosen for each missing digest (its smallest id), and the texts of these rows
are encoded where the planner's join puts them, spread evenly whatever the size
of a group of copies.

Defined results: null counts as the empty text; repeated rows give repeated
rows; rows with a null id are counted like others; an empty table gives an empty
table and leaves the cache as it is; other columns are not carried.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import id_and_text, map_batches
from tidewater.session import materialize

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


@lru_cache(maxsize=4)
def _encoder(path: str):
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer: its file's bytes and the version of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as lib
    else:
        import tokenizers as lib
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{lib.__name__} {lib.__version__}".encode()).hexdigest()


def count_texts(texts: pa.Array, path: str, at_once: int = 1 << 22) -> np.ndarray:
    """Token counts of a batch, encoded in runs of about ``at_once`` characters."""
    encode, out, run, size = _encoder(path), [], [], 0
    for t in texts.to_pylist():
        run.append(t or "")
        size += len(run[-1])
        if size >= at_once:
            out += encode(run)
            run, size = [], 0
    return np.array(out + (encode(run) if run else []), np.int64)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; a cache not yet written is empty."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def count(df: DataFrame, cache_path: str, tokenizer: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``df``; new counts are appended to the cache."""
    spark = df.sparkSession
    version = tokenizer_digest(tokenizer)
    docs = id_and_text(df, id_col, text_col).withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = materialize(docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    stored = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    missing = materialize(keys.groupBy("digest").agg(F.min("doc_id").alias("chosen"))
                          .join(stored, "digest", "left_anti"), "missing")
    if not missing.isEmpty():
        chosen = docs.withColumnRenamed("digest", "own").join(
            missing, (F.col("own") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("chosen")), "left_semi")

        def encode(b: pa.RecordBatch) -> pa.RecordBatch:
            # rows that repeat both id and text come together: one of them in a batch is enough
            first = {d: i for i, d in reversed(list(enumerate(b.column(0).to_pylist())))}
            b = b.take(pa.array(sorted(first.values())))
            return pa.RecordBatch.from_arrays([b.column(0), pa.array(count_texts(b.column(1), tokenizer))], ["digest", "n_tokens"])
        fresh = map_batches(chosen.select(F.col("own").alias("digest"), "text"), encode, "digest binary, n_tokens long") \
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    # one row for each digest, even if two runs appended it; written, so that the join below can split a group of copies
    counts = materialize(read_cache(spark, cache_path).where(F.col("tokenizer") == version)
                         .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
