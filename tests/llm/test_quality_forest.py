import re

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import quality_forest as Q

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def check(spark, df):
    got = Q.judge(df, labels(spark), F.col("quality") == 1)
    rows = sorted(tuple(-1 if v is None else v for v in r) for r in got.select("doc_id", *Q.BASE, "base_failed").collect())
    want = []
    for r in df.select("doc_id", "text").collect():
        b = brute(r.text)
        want.append((-1 if r.doc_id is None else r.doc_id, *b, b[0] < 10 or 100 * b[4] > 20 * b[0]))
    assert rows == sorted(want)
    assert got.where("base_failed AND kept").count() == 0


def test_base_statistics_equal_brute_force(spark, documents, odd):
    check(spark, documents)
    check(spark, odd)


def test_random_texts_equal_brute_force():
    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab \n\t#é"), rng.integers(0, 80))) for _ in range(400)]
    base, features = Q.batch_statistics(pa.array(texts))
    assert [tuple(r) for r in base.tolist()] == [brute(t) for t in texts]
    assert features.shape == (400, len(Q.FEATURES)) and np.isfinite(features).all()


def test_forest_separates_labelled_rows(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.judge(docs, marks, F.col("quality") == 1).join(marks, "doc_id").where("NOT base_failed")
    by = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert by[1] > 0.99 and by[0] < 0.6


def test_path_lengths_by_hand():
    # one feature, one point in [0, 1]: every split ends beside or around it
    f = Q.grow(np.array([[0.1], [0.2], [0.15], [0.12]]), np.array([0.0]), np.array([1.0]), trees=300, rows=4, depth=8)
    s = f.scores(np.array([[0.14], [0.9]]))
    assert s[1] > s[0] and ((s > 0) & (s < 1)).all()


def test_no_labels_and_empty_tables(spark, odd):
    none = labels(spark).limit(0)
    got = Q.judge(odd, none, F.col("quality") == 1)
    assert got.where("kept = base_failed").count() == 0
    assert Q.judge(odd.limit(0), labels(spark), F.col("quality") == 1).collect() == []
    holes = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1)], "doc_id long, quality int")
    assert Q.judge(odd, holes, F.col("quality") == 1).count() == odd.count()


def test_keep_passes_all_columns(spark, odd):
    kept = Q.keep(odd, labels(spark).limit(0), F.col("quality") == 1)
    assert kept.schema == odd.schema
    want = [r.doc_id for r in odd.collect() if not (lambda b: b[0] < 10 or 100 * b[4] > 20 * b[0])(brute(r.text))]
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, want))


def test_threshold_weighs_good_against_bad():
    good, bad = np.zeros(100), np.zeros(100)
    good[[10, 40, 60]], bad[[39, 50, 70]] = (990, 8, 2), (1, 30, 69)
    # at 0.40 1 % of the good rows would go, at 0.50 two in a thousand: worth it for the last 69 % of the bad ones
    assert Q.threshold(good, bad, 0.005) == 0.50
    assert Q.threshold(good, bad, 0.05) == 0.50
    assert Q.threshold(good, bad, 0.0) == 0.70
    assert Q.threshold(good, np.zeros(100), 0.005) == 0.41
    assert Q.threshold(np.zeros(100), bad, 0.005) == 0.39


def test_few_bad_rows_stay_and_few_good_ones_go(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    docs, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.judge(docs, marks, F.col("quality") == 1).join(marks, "doc_id").where("NOT base_failed")
    by = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    print("good kept", by[1], "bad kept", by[0])
    assert by[1] >= 0.995 and by[0] <= 0.05
