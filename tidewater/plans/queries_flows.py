"""Registered flow runs: each of the four flows is run twice, with other input the
second time, and its outputs are counted against the source tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.relational import labelled_counts
from tidewater.plans import standins as SI
from tidewater.plans.flows import market, medallion, rides, sensor
from tidewater.plans.queries_stream import _closed
from tidewater.plans.registry import register, rounded
from tidewater.session import scratch_dir
from tidewater.sources import writers as W

ASOF = SI.ASOF


@register("flow_rides_rerun", """SELECT o.o_orderstatus AS vendor_id, count(*) AS trips, round(sum(l.l_extendedprice), 4) AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE o.o_orderstatus <> 'F' GROUP BY 1""")
def flow_rides_rerun(spark, sf):
    """All trips by way of a CSV landing, then the trips of fewer vendors: the fact holds exactly these."""
    trips, out = SI.trips(SI.Tables(spark, sf)), scratch_dir(spark, "flow-rides")
    rides.run(spark, trips.withColumnRenamed("pickup_datetime", "tpep_pickup_datetime"), out, landing=True)
    second = rides.run(spark, trips.where(F.col("vendor_id") != "F"), out)
    by = second["facts"].join(second["dim_vendor"], "vendor_key").groupBy("vendor_id")
    return rounded(by.agg(F.sum("total_trips").alias("trips"), F.sum("total_revenue").alias("revenue")))


@register("flow_medallion_rerun", """SELECT lower(r.r_name) AS region, count(*) AS videos, CAST(sum(trunc(l.l_extendedprice)) AS BIGINT) AS views
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name IN ('ASIA', 'EUROPE') GROUP BY 1""")
def flow_medallion_rerun(spark, sf):
    """Half of the bronze rows, then all of them, with regions in several spellings: silver keeps the wanted
    regions and gold counts every row once."""
    t, out = SI.Tables(spark, sf), scratch_dir(spark, "flow-medallion")
    bronze = SI.videos(t)
    spelled = F.when(F.col("comment_count") % 2 == 0, F.concat(F.lit(" "), F.upper("region"), F.lit(" "))).otherwise(F.col("region"))
    bronze = bronze.withColumn("region", spelled).withColumn("views", F.col("views").cast("string"))
    medallion.run(spark, bronze.where(F.col("comment_count") <= 3), SI.categories(t), out, ASOF, ["Asia", "europe"])
    second = medallion.run(spark, bronze, SI.categories(t), out, ASOF, ["Asia", "europe"])
    return second["trending_analytics"].groupBy("region").agg(F.sum("total_videos").alias("videos"), F.sum("total_views").alias("views"))


@register("flow_sensor_twice", f"""SELECT 'archive' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'enriched', count(*) FROM events UNION ALL SELECT 'counts', count(*) FROM ({_closed('1 HOUR')})
UNION ALL SELECT 'logs', count(*) FROM ({_closed('1 HOUR')})""")
def flow_sensor_twice(spark, sf):
    """Two deliveries, a run after each: every reading is archived once and every closed window logged once."""
    inbox, out = scratch_dir(spark, "flow-sensor-inbox"), scratch_dir(spark, "flow-sensor")
    r, cut = SI.readings(SI.Tables(spark, sf)), F.lit("2024-01-16").cast("timestamp")
    for part in (r.where(F.col("processing_time") < cut), r.where(F.col("processing_time") >= cut)):
        part.write.mode("append").options(**W.JSON_OPTIONS).json(inbox)
        res = sensor.run(spark, inbox, out, width="1 hour")
    return labelled_counts({k: res[k] for k in ("archive", "enriched", "counts", "logs")})


@register("flow_market_two_snapshots", """SELECT 'coin_data' AS table_name, 2 * count(*) AS row_count FROM part
UNION ALL SELECT 'market_data', 2 * count(*) FROM part UNION ALL SELECT 'price_data', 2 * count(*) FROM part
UNION ALL SELECT 'current_coin_data', count(*) FROM part UNION ALL SELECT 'current_market_data', count(*) FROM part
UNION ALL SELECT 'current_price_data', count(*) FROM part UNION ALL SELECT 'latest', least(10, count(*)) FROM part""")
def flow_market_two_snapshots(spark, sf):
    """Two snapshots, the second without some raw fields: each is landed once in three tables, each table has one
    current row per coin."""
    coins, out = SI.coins(SI.Tables(spark, sf)), scratch_dir(spark, "flow-market")
    market.run(spark, coins, out, "2024-01-31 00:00:00", ASOF)
    res = market.run(spark, coins.drop("ath", "ath_date", "circulating_supply"), out, "2024-02-01 00:00:00", ASOF)
    return labelled_counts({k: res[k] for k in ("coin_data", "market_data", "price_data", "current_coin_data",
                                                "current_market_data", "current_price_data", "latest")})


@register("market_latest_report", f"""SELECT 'coin-' || CAST(p_partkey AS VARCHAR) AS id, round(p_retailprice * p_size * 1e7, 2) AS market_cap,
       p_retailprice AS current_price, round(p_retailprice * 1e6 / (p_retailprice * p_size * 1e7), 6) AS volume_to_mcap_ratio
FROM part ORDER BY p_retailprice * p_size DESC, id LIMIT 10""")
def market_latest_report(spark, sf):
    """The latest-snapshot report (11 columns, top 10), compared on those that plain SQL repeats."""
    tables = market.transform(SI.coins(SI.Tables(spark, sf)), ASOF, ASOF)
    report = market.latest_prices(tables["coin_data"], tables["market_data"], tables["price_data"])
    assert report.columns == list(market.REPORT)
    return report.select("id", F.col("market_cap").cast("double").alias("market_cap"), "current_price", "volume_to_mcap_ratio")
