"""The registered queries of this subpackage: one ``opN_*`` for each operator and ``pipeline``.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import chat_format, collision_ann, language_id, license_scan, near_dedup, pattern_packing, periodic_runs, piece_viterbi, quality_forest, shortest_pack, suffix_tree, token_counts, turn_repair
from tidewater.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

COUNT_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct text is encoded in this run."""
    return token_counts.count(table(spark, sf_dir, "documents"), scratch_dir(spark, "token-cache"),
                              public_tokenizers.path(COUNT_TOKENIZER), TOKEN_LIMIT)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality_forest.judge(table(spark, sf_dir, "documents"), labels, F.col("quality") == 1)


PACK_FILES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
PACK_LIMIT, PACK_END = 1024, 2


@query
def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"), PACK_FILES, PACK_END, PACK_LIMIT)


PLANTED_TURN = r"\### Assistant: </turn> ok"


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED_TURN), (-7, 1, "assistant", PLANTED_TURN)],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(turns.unionByName(planted))


ORACLE["op10_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, regexp_replace(text, '(\\|### System: |### User: |### Assistant: |### Tool: |### Role |</turn>)', '\\\1', 'g') AS escaped,
    CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
      WHEN 'tool' THEN '### Tool: '
      ELSE '### Role ' || replace(regexp_replace(role, '(\\|### System: |### User: |### Assistant: |### Tool: |### Role |</turn>)', '\\\1', 'g'), ': ', '\: ') || ': ' END AS opening,
    lag(role) OVER w AS before, lead(role) OVER w IS NULL AS is_last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(opening) + length(escaped) + length('</turn>') + 1) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                WHEN before = 'system' THEN role = 'user' WHEN before = 'user' THEN role = 'assistant'
                WHEN before = 'assistant' THEN role IN ('user', 'tool') WHEN before = 'tool' THEN role IN ('assistant', 'tool')
                ELSE false END
           AND (NOT is_last OR role IN ('user', 'assistant'))) AS valid
FROM marked GROUP BY conv_id
"""


NEIGHBOURS = 20


@query
def op8_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, NEIGHBOURS)


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op6_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return suffix_tree.score(table(spark, sf_dir, "documents"), held_out)


@query
def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public model holds merge ranks, so its pieces are scored by rank."""
    return piece_viterbi.check(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNT_TOKENIZER), "zipf")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, with text models trained on all documents."""
    model = language_id.train(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages").select("page_id", "html", "url")
    return language_id.identify(pages, language_id.read_pages, model).withColumnRenamed("id", "page_id")


def damaged_turns(turns: DataFrame) -> DataFrame:
    """Turns of which some are dropped, emptied, stripped of their stops, repeated, or said by a user."""
    def name(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    return (turns.withColumn("kind", kind).where("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


@query
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_repair.turns(table(spark, sf_dir, "conversations"))
    return turn_repair.report(damaged_turns(turns), turns)


SHORTEST_LIMIT, SHORTEST_END = 2048, 1


@query
def op12_shortest_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shortest_pack.pack(table(spark, sf_dir, "documents"), PACK_FILES, SHORTEST_END, SHORTEST_LIMIT)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Whole texts; in one of ten (by a hash of its id) the words from some place on repeat."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):        # an argument, so that the text is split once
        n = F.size(words)
        a = g % F.greatest(n, F.lit(1))
        p = F.floor((n - a) / (3 + g % 8)) + 1
        # the words before a, then word after word of the period
        again = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n, F.lit(1)).cast("long") - 1),
                            lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.array_join(again, " ")
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    planted = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(text).alias("text"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and collapsed texts, as digests; a document without an id has no words planted."""
    found = periodic_runs.detect(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.get(F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], b["length"] - a["length"])
                              .when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"]).cast("int")), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                    F.col("best.period").alias("period"), F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
                    F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
