import public_tokenizers
import sentencepiece

from tidewater.llm import token_counts as T
from tidewater.session import scratch_dir

MODEL, JSON = (public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "byte_bpe_50k.json"))


def counts(df, cache, path=MODEL):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens, r.over_limit) for r in T.count(df, cache, path, 100).collect())


def want(df, encode):
    return sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()), n := encode(r.text or ""), n > 100) for r in df.select("doc_id", "text").collect())


def test_equals_the_library(spark, documents, odd):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (documents, odd):
        assert counts(df, scratch_dir(spark, "cache")) == want(df, lambda t: len(sp.encode(t)))


def test_other_tokenizer_file(spark, odd):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    assert counts(odd, scratch_dir(spark, "cache"), JSON) == want(odd, lambda t: len(tok.encode(t, add_special_tokens=False).ids))


def test_only_distinct_misses_are_encoded_and_appended(spark, odd):
    cache = scratch_dir(spark, "cache")
    first = counts(odd, cache)
    stored = spark.read.parquet(cache)
    assert stored.count() == odd.selectExpr("coalesce(text, '')").distinct().count()
    files = stored.inputFiles()
    assert counts(odd, cache) == first and spark.read.parquet(cache).inputFiles() == files      # all hits: nothing is written
    more = odd.selectExpr("doc_id", "text").union(spark.createDataFrame([(99, "a new text")], "doc_id long, text string"))
    counts(more, cache)
    assert spark.read.parquet(cache).count() == stored.count() + 1


def test_a_stored_count_is_used(spark):
    cache, df = scratch_dir(spark, "cache"), spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    counts(df, cache)
    spark.read.parquet(cache).selectExpr("digest", "tokenizer", "12345L AS n_tokens").write.parquet(other := scratch_dir(spark, "cache"))
    assert counts(df, other)[0][2] == 12345
    assert counts(df, other, JSON)[0][2] != 12345          # another tokenizer has keys of its own


def test_empty_table(spark, odd):
    assert counts(odd.limit(0), scratch_dir(spark, "cache")) == []
