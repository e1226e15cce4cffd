"""Relational operators: results against plain-window brute force, skew, plans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import relational as R
from tidewater.operators.star import build_dim


def skewed(spark, n=3000):
    # one group holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 17).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))


def test_rank_within_matches_window_on_hot_group(spark):
    df = skewed(spark)
    got = R.rank_within(df, ["g"], [F.col("v").desc(), F.col("id")], "rk")
    want = df.withColumn("rk", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")))
    assert got.select("id", "rk").exceptAll(want.select("id", F.col("rk").cast("long"))).count() == 0
    assert got.count() == df.count()


def test_global_rank_is_a_dense_sequence_in_order(spark):
    # rows are numbered inside range partitions; only the per-partition count
    # table (one row per partition) is ordered in one place
    df = skewed(spark)
    got = R.global_rank(df, [F.col("v"), F.col("id")], "rk").collect()
    assert sorted(r.rk for r in got) == list(range(1, df.count() + 1))
    ordered = [(r.v, r.id) for r in sorted(got, key=lambda r: r.rk)]
    assert ordered == sorted(ordered)


def test_share_pct_joins_group_totals(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5)], "g string, v long")
    got = {(r.g, r.v): r.s for r in R.share_pct(df, "v", ["g"], "s").collect()}
    assert got == {("a", 1): 25.0, ("a", 3): 75.0, ("b", 5): 100.0}


def test_dedup_latest_is_deterministic_with_ties(spark):
    df = spark.createDataFrame([(1, 10, "x"), (1, 10, "y"), (1, 5, "z"), (2, 1, "w")], "k int, t int, p string")
    got = sorted(tuple(r) for r in R.dedup_latest(df, ["k"], ["t"]).collect())
    assert got == [(1, 10, "y"), (2, 1, "w")]


def test_lookup_left_default_and_missing_dim(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (1, "uno")], "id int, name string")
    got = {(r.k, r.label) for r in R.lookup_left(fact, dim, "k", "id", {"name": "label"},
                                                   {"label": "Unknown"}).collect()}
    assert got == {(1, "one"), (2, "Unknown"), (None, "Unknown")}
    assert [r.label for r in R.lookup_left(fact, None, "k", "id", {"name": "label"}, {"label": "U"}).collect()] == \
        ["U", "U", "U"]


def test_lookup_left_text_keys_neither_double_nor_fail(spark):
    fact = spark.createDataFrame([(1,), (2,)], "k long")
    dim = spark.createDataFrame([("1", "a"), ("01", "b"), ("x", "c")], "id string, name string")
    got = sorted((r.k, r.label) for r in R.lookup_left(fact, dim, "k", "id", {"name": "label"}, {"label": "?"}).collect())
    assert got == [(1, "a"), (2, "?")]


def test_lookup_left_reads_dotted_columns(spark):
    fact = spark.createDataFrame([(1,)], "k long")
    nested = spark.sql("SELECT '1' AS id, named_struct('title', 'T') AS snippet")
    flat = spark.sql("SELECT '1' AS id, 'T' AS `snippet.title`")
    for dim in (nested, flat):
        assert R.lookup_left(fact, dim, "k", "id", {"snippet.title": "label"}).first().label == "T"


def test_latest_snapshot_join(spark):
    a = spark.createDataFrame([("x", 1, "A"), ("x", 2, "B")], "id string, extracted_at int, n string")
    b = spark.createDataFrame([("x", 1, 10), ("x", 2, 20)], "id string, extracted_at int, m int")
    got = R.latest_snapshot_join([a, b]).collect()
    assert [(r.n, r.m) for r in got] == [("B", 20)]


def test_top_n_tie_break(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "k string, v int")
    assert [r.k for r in R.top_n(df, [F.col("v").desc(), F.col("k")], 2).collect()] == ["a", "b"]


def test_build_dim_rank_and_hash(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert [(r.c, r.key) for r in build_dim(df, ["c"], "key").orderBy("key").collect()] == \
        [(None, 1), ("a", 2), ("b", 3)]
    h = build_dim(df, ["c"], "key", method="hash")
    assert h.count() == 3 and h.select("key").distinct().count() == 3


def test_labelled_counts(spark):
    out = R.labelled_counts({"x": spark.range(3), "y": spark.range(0)}).collect()
    assert {(r.table_name, r.row_count) for r in out} == {("x", 3), ("y", 0)}
