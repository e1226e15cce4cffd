"""The pipeline's stages, each on its predecessor's rows, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tidewater.llm import language_id, quality_forest
from tidewater.session import materialize

from .conftest import SF
from .test_near_dedup import brute
from .test_packing_and_chat import check_packing
from .test_quality_forest import brute as statistics

SF2 = SF.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF2}/documents.parquet"), []
    for name, stage in C.STAGES:
        out.append((name, docs, docs := materialize(stage(spark, docs, SF2), name)))
    return {name: (given, made) for name, given, made in out}


def test_stages_and_columns(spark, outputs):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "language_id", "minhash_near_dedup", "best_fit_packing"]
    documents = spark.read.parquet(f"{SF2}/documents.parquet")
    for name, (given, made) in outputs.items():
        if name != "best_fit_packing":
            assert made.schema == documents.schema
            assert made.exceptAll(given).isEmpty()


def test_quality_stage(spark, outputs):
    given, made = outputs["quality_rules"]
    kept = {r.doc_id for r in made.select("doc_id").collect()}
    for r in given.collect():
        b = statistics(r.text)
        if b[0] < 10 or 100 * b[4] > 20 * b[0]:
            assert r.doc_id not in kept
    marks = spark.read.parquet(f"{SF2}/labels.parquet")
    judged = quality_forest.judge(given, marks, F.col("quality") == 1)
    assert kept == {r.doc_id for r in judged.where("kept").collect()}


def test_language_stage(spark, outputs):
    given, made = outputs["language_id"]
    rows = given.select("doc_id", "text", "lang", F.lower("source"))
    judged = language_id.identify(rows, language_id.read_plain, language_id.train(given))
    assert {r.doc_id for r in made.collect()} == {r.id for r in judged.where("kept").collect()}


def test_near_dedup_stage(outputs):
    given, made = outputs["minhash_near_dedup"]
    want = {w[0] for w in brute([(r.doc_id, r.text) for r in given.collect()], C.SHINGLE_WORDS, C.SIMILARITY) if w[3]}
    assert {repr(r.doc_id) for r in made.collect()} == want


def test_packing_stage(outputs):
    given, made = outputs["best_fit_packing"]
    n, least = check_packing([(r.doc_id, r.text) for r in given.collect()], made.collect(), C.SEQUENCE_TOKENS, C.END_TOKEN)
    assert n <= 1.02 * least + 2


def test_run_equals_the_stages(spark, outputs):
    order = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert order(C.run(spark, SF2)) == order(outputs["best_fit_packing"][1])


def test_stages_on_odd_rows_and_empty_tables(spark, odd):
    for name, stage in C.STAGES:
        got, none = stage(spark, odd, SF), stage(spark, odd.limit(0), SF)
        assert none.collect() == [] and got.columns == none.columns
        if name != "best_fit_packing":
            assert got.schema == odd.schema and got.exceptAll(odd).isEmpty()


def test_registration(spark):
    import __spark_entry__ as E
    names = [k for k in E.queries() if k.startswith("op") and k[2].isdigit()]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())
