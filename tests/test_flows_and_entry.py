"""The four flows end to end on sf0.001 (run twice = run once) and the driver contract."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import standins as SI
from tidewater.plans.flows import market, medallion, rides, sensor

SF = "/root/testdata/sf0.001"
ASOF = SI.ASOF


def totals(df, col):
    return df.agg(F.count(F.lit(1)), F.sum(col)).first()


def test_rides_flow_idempotent(spark, tmp):
    t = SI.Tables(spark, SF)
    out = tmp("rides")
    first = rides.run(spark, SI.trips(t), out)
    a = totals(first["total_revenue"], "revenue")
    dims = (first["dim_vendor"].count(), first["dim_payment"].count())
    second = rides.run(spark, SI.trips(t), out)      # overwrites the first run's files
    assert totals(second["total_revenue"], "revenue") == pytest.approx(a)        # sums of doubles, in any order
    assert dims == (3, 5)
    assert second["facts"].agg(F.sum("total_trips")).first()[0] == t.lineitem.count()


def test_medallion_flow_idempotent(spark, tmp):
    t = SI.Tables(spark, SF)
    out = tmp("medallion")
    first = medallion.run(spark, SI.videos(t), SI.categories(t), out, ASOF)
    a = totals(first["trending_analytics"], "total_views")
    second = medallion.run(spark, SI.videos(t), SI.categories(t), out, ASOF)
    assert totals(second["trending_analytics"], "total_views") == pytest.approx(a)
    assert second["channel_analytics"].where("rank_in_region = 1").count() == \
        second["channel_analytics"].select("region").distinct().count()


def test_medallion_flow_from_folders(spark, tmp):
    """Bronze as CSV files of two header orders and API JSON rows, the reference as nested JSON documents;
    mixed-type numbers, an all-null column, a region in several spellings; silver is registered."""
    bronze, ref, out = tmp("m-bronze"), tmp("m-ref"), tmp("m-out")
    cols = "video_id string, trending_date string, title string, channel_title string, category_id string, views string, likes string, dislikes string, comment_count string, region string"
    rows = [(f"v{i}", "17.14.11", "t", f"c{i % 3}", str(i % 2 + 1), "many" if i == 5 else str(i * 10), "3", "1", "0", (" US ", "us", "Us")[i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, cols)
    df.where("video_id < 'v2'").write.option("header", True).csv(f"{bronze}/a")
    df.where("video_id >= 'v2' AND video_id < 'v5'").select(*reversed(df.columns)).write.option("header", True).csv(f"{bronze}/b")
    df.where("video_id >= 'v5'").write.json(f"{bronze}/api")
    docs = ['{"kind": "k", "items": [{"id": "1", "snippet": {"title": "One"}}, {"id": "01", "snippet": {"title": "Uno"}}, {"id": "x", "snippet": {"title": "X"}}]}']
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(ref)
    for _ in range(2):
        res = medallion.run(spark, bronze, ref, out, ASOF, regions=["US"], database="medallion_folders")
    assert res["silver"].count() == 30 and "tags" not in res["silver"].columns
    got = {r.category_name: (r.video_count, r.total_views) for r in res["category_analytics"].collect()}
    assert got == {"One": (15, sum(i * 10 for i in range(0, 30, 2))), "Unknown": (15, sum(i * 10 for i in range(1, 30, 2)) - 50)}
    with pytest.raises(RuntimeError):       # rows stamped long ago are not fresh
        medallion.run(spark, bronze, ref, tmp("m-old"), ASOF, regions=["us"], processed_at="2023-01-01 00:00:00")


def test_queries_run_from_any_working_directory():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry", {os.path.join(root, '__spark_entry__.py')!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
print("ROWS", entry.queries()["a7_read_json_concat"](spark, {SF!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/tmp", env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_market_flow_two_snapshots(spark, tmp):
    t = SI.Tables(spark, SF)
    out = tmp("market")
    market.run(spark, SI.coins(t), out, "2024-01-31 00:00:00", ASOF)
    res = market.run(spark, SI.coins(t), out, "2024-02-01 00:00:00", ASOF)
    n = t.part.count()
    assert res["coin_data"].count() == 2 * n           # each snapshot appended once
    assert res["current"].count() == n                 # one current row per coin
    assert res["latest"].select("extracted_at").distinct().count() == 1


def test_sensor_flow(spark, tmp):
    inbox, out = tmp("sensor-inbox"), tmp("sensor")
    SI.readings(SI.Tables(spark, SF)).write.json(inbox)
    res = sensor.run(spark, inbox, out, width="1 hour")
    n = SI.Tables(spark, SF).events.count()
    assert res["archive"].count() == n and res["enriched"].count() == n
    assert res["logs"].count() == res["counts"].count()


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["vendor_id", "revenue"] and df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 150


ORACLE_SAMPLE = ["p3_total_revenue", "p4_trending_daily", "p4_channel_summary", "f3_global_rank",
                 "e17_dedup_latest", "l1_l5_orders_checks", "a2_read_csv_by_name", "j2_tumbling_count_1min",
                 "k2_merge_upsert", "i2_title_case", "d5_latest_snapshot_join"]


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    from tests.oracle_compare import compare, duck
    r = compare(spark, duck(SF), name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def test_trips_land_compressed(spark, tmp):
    from tidewater.plans import standins as SI
    from tidewater.plans.flows import rides
    from tidewater.sources import readers as RD
    out, trips = tmp("rides-landing"), SI.trips(SI.Tables(spark, SF))
    facts = rides.run(spark, trips, out, landing=True)["facts"]
    assert RD.list_files(spark, f"{out}/raw", suffix=".csv.gz").count() > 0 and RD.list_files(spark, f"{out}/raw", suffix=".csv").count() == 0
    assert facts.agg(F.sum("total_trips")).first()[0] == trips.count()


def test_gold_shuffles_no_row_before_its_roll_ups(spark, tmp, monkeypatch):
    """What the gold tables share is written as the rows come, once."""
    from tidewater.plans import standins as SI
    from tidewater.plans.flows import medallion as M
    shared, kept = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda df, name: shared.append(df) or kept(df, name))
    bronze = SI.videos(SI.Tables(spark, SF))
    gold = M.run(spark, bronze, None, tmp("medallion-shared"), SI.ASOF)
    assert len(shared) == 1
    plan = shared[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert gold["trending_analytics"].agg(F.sum("total_videos")).first()[0] == bronze.count()
    assert gold["category_analytics"].agg(F.sum("video_count")).first()[0] == bronze.count()
