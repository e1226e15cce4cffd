"""Corpus pipeline: stages applied to ``documents`` one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All but the last return
the rows that they keep, with every column of theirs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import language_id, near_dedup, pattern_packing, quality_forest
from tidewater.session import materialize

SHINGLE_WORDS, SIMILARITY = 5, 80
SEQUENCE_TOKENS, END_TOKEN = 1024, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the forest keep."""
    return quality_forest.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.col("quality") == 1)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages, as far as text, declaration and source tell."""
    return language_id.keep(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_dedup.keep(docs, SHINGLE_WORDS, SIMILARITY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of ``SEQUENCE_TOKENS``."""
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return pattern_packing.pack(docs, files, END_TOKEN, SEQUENCE_TOKENS)


STAGES = [("quality_rules", quality_rules), ("language_id", known_language),
          ("minhash_near_dedup", near_duplicates), ("best_fit_packing", packing)]

#: Two stages apply models trained on the data, and tokens come from a tokenizer: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
