"""Plan assertions on registered queries and skew properties against brute force."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import relational as R

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["p3_total_revenue", "m3_fact_trips", "p4_trending_daily", "p4_category_daily",
                                  "e17_dedup_latest", "l1_l5_orders_checks", "d1_lookup_left", "i2_title_case"])
def test_hot_path_queries_stay_in_the_jvm(spark, name):
    import __spark_entry__ as E
    plan = plan_of(E.queries()[name](spark, SF))
    assert not any(node in plan for node in PYTHON_NODES), plan


def test_fact_build_broadcasts_small_dimensions(spark):
    from tidewater.plans import standins as SI
    from tidewater.plans.flows import rides
    g = rides.grain(SI.trips(SI.Tables(spark, SF)))
    f = rides.fact(g, rides.dimensions(g))
    assert plan_of(f).count("BroadcastHashJoin") >= 3


def test_scans_read_only_needed_columns(spark):
    from tidewater.plans import standins as SI
    t = SI.Tables(spark, SF)
    plan = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan


def hot(spark, n=6000):
    # a third of the rows share one key
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") * 7 % 101).alias("t"), F.col("id").alias("v"))


def test_share_pct_hot_key_matches_window(spark):
    df = hot(spark)
    got = R.share_pct(df, "v", ["k"], "s")
    want = df.withColumn("s", F.round(F.col("v") / F.sum("v").over(Window.partitionBy("k")) * 100, 2))
    assert got.exceptAll(want).count() == 0 and got.count() == df.count()


def test_dedup_latest_hot_key_matches_row_number(spark):
    df = hot(spark)
    got = R.dedup_latest(df, ["k"], ["t", "v"])
    w = Window.partitionBy("k").orderBy(F.col("t").desc(), F.col("v").desc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dedup_latest_combines_map_side(spark):
    plan = plan_of(R.dedup_latest(hot(spark), ["k"], ["t"]))
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + plan.count("SortAggregate") >= 2


def test_category_gold_scans_lineitem_once(spark):
    """The share reads a written aggregate, not the joins a second time."""
    import __spark_entry__ as E
    assert plan_of(E.queries()["p4_category_daily"](spark, SF)).count("lineitem.parquet") == 0


def test_merge_reads_touched_buckets_only(spark, tmp, monkeypatch):
    from tidewater.operators import cdc as CDC
    target = tmp("pruned")
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("t"))
    CDC.merge_upsert(spark, target, rows, "k", ["t"], buckets=16)
    read = []
    real = CDC._merge
    monkeypatch.setattr(CDC, "_merge", lambda current, *rest: read.extend(current.inputFiles()) or real(current, *rest))
    CDC.merge_upsert(spark, target, rows.where("k = 7"), "k", ["t"], buckets=16)
    assert len({re.search("_bucket=([0-9]+)", f)[1] for f in read}) == 1


def _scans(plans, table):
    return sum(p.count(f"/{table}.parquet") for p in plans)


def test_channel_gold_scans_lineitem_once(spark, monkeypatch):
    """Distinct videos are counted in the aggregation of the sums: judged on the frames that are written."""
    import __spark_entry__ as E
    from tidewater.operators import relational as R
    plans = []
    real = R.materialize
    monkeypatch.setattr(R, "materialize", lambda df, name: plans.append(plan_of(df)) or real(df, name))
    plans.append(plan_of(E.queries()["p4_channel_summary"](spark, SF)))
    assert _scans(plans, "lineitem") == 1


def test_medallion_reads_bronze_once_and_silver_once_for_gold(spark, tmp, monkeypatch):
    from tidewater.plans import standins as SI
    from tidewater.plans.flows import medallion as M
    from tidewater.operators import relational as R
    from tidewater.sources import writers as W
    read, out = [], tmp("medallion-once")

    def note(df):       # the tables that a frame about to be written reads, by file
        read.append({name for name in ("lineitem.parquet", "clean_statistics") for f in df.inputFiles() if name in f})
    for module, name in ((M, "materialize"), (R, "materialize")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, label, real=real: note(df) or real(df, label))
    write = W.write_idempotent       # write_rebalanced ends there, too
    monkeypatch.setattr(W, "write_idempotent", lambda df, *a: note(df) or write(df, *a))
    t = SI.Tables(spark, SF)
    M.run(spark, SI.videos(t), SI.categories(t), out, SI.ASOF)
    assert sum("lineitem.parquet" in x for x in read) == 1
    assert sum("clean_statistics" in x for x in read) == 1


def test_empty_columns_are_found_in_footers(spark, tmp):
    from tidewater.sources import readers as RD
    out, setting = tmp("footers"), spark.conf.get("spark.sql.parquet.aggregatePushdown")
    spark.range(50).selectExpr("id", "cast(null AS string) AS gone", "if(id = 7, 'x', null) AS rare", "id % 3 AS p").write.partitionBy("p").parquet(out)
    assert RD.filled_columns(spark, out) == ["id", "rare", "p"]
    spark.range(5).selectExpr("id", "cast(null AS string) AS gone", "'y' AS extra", "1L AS p").write.mode("append").partitionBy("p").parquet(out)
    assert set(RD.filled_columns(spark, out)) == {"id", "rare", "extra", "p"}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == setting


def test_wide_joins_of_large_tables_get_more_tasks(spark, monkeypatch):
    """Tasks grow with the lines, beyond the session's shuffle partitions; the rows stay the same."""
    from tidewater.plans import standins as SI
    t = SI.Tables(spark, SF)
    want = {f: f(t) for f in (SI.videos, SI.trips, SI.categories)}
    monkeypatch.setattr(SI, "ROWS_PER_TASK", 500)
    n = t.lineitem.count() // 500
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for f, before in want.items():
        now = f(t)
        assert f", {n}), REPARTITION_BY_NUM" in plan_of(now) and "REPARTITION_BY_NUM" not in plan_of(before)
        assert now.exceptAll(before).count() == 0 and now.count() == before.count()
