"""Stand-in datasets derived by Spark from the driver tables.

The four flows were written for rides, sensors, coins and videos.  The driver
ships TPC-H-like tables instead, so each flow's input is a projection/join of
those tables (``FIXTURES.md`` section 5).  Everything here is lazy DataFrame code
whose size grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# asof used by every registered query (a literal, never now()).
ASOF = "2024-02-01 00:00:00"


class Tables:
    """``Tables(spark, dir).orders`` -> lazily read ``dir/orders.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def geo(self) -> DataFrame:
        """nation + region names, 25 rows (a code table: bounded by definition)."""
        return (self.nation.join(F.broadcast(self.region), F.col("n_regionkey") == F.col("r_regionkey"))
                .select("n_nationkey", "n_name", "r_name"))


# Rows of a wide join or aggregation that one task takes.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, rows: int, key: str) -> DataFrame:
    """Deal ``df`` by ``key`` to as many tasks as ``rows`` ask for, so that a task's memory does not grow with the
    table.  A table that the session's shuffle partitions suffice for is left to the planner."""
    n = rows // ROWS_PER_TASK
    return df.repartition(n, key) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def trips(t: Tables) -> DataFrame:
    """Ride trips: one per lineitem row.

    vendor = order status, payment = order priority, pickup = customer region /
    nation, dropoff = supplier region / nation, amount = extended price.
    """
    geo = t.geo
    pick = geo.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("pickup_city"),
                      F.col("n_name").alias("pickup_location"))
    drop = geo.select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("dropoff_city"),
                      F.col("n_name").alias("dropoff_location"))
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    od = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    # pick / drop are the 25-row nation table: broadcast is bounded by definition
    cu = t.customer.select("c_custkey", "c_nationkey").join(F.broadcast(pick), "c_nationkey")
    su = t.supplier.select("s_suppkey", "s_nationkey").join(F.broadcast(drop), "s_nationkey")
    oc = od.join(cu, F.col("o_custkey") == F.col("c_custkey"))      # orders meet their customers first: the lines are shuffled once
    j = (spread(li, t.lineitem.count(), "l_orderkey").join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(su, F.col("l_suppkey") == F.col("s_suppkey")))
    return j.select(
        F.col("o_orderstatus").alias("vendor_id"),
        F.col("o_orderpriority").alias("payment_type"),
        "pickup_city", "pickup_location", "dropoff_city", "dropoff_location",
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tolls_amount"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def videos(t: Tables) -> DataFrame:
    """Trending-video rows (bronze shape, 17 columns): one per lineitem row.

    views = extended price, likes = quantity, dislikes = discount in points,
    comments = line number, channel = part brand, category id = part key (its
    name comes from the part lookup), region = customer's region (lower case),
    trending date = ship date written ``yy.dd.MM``.
    """
    geo = t.geo.select(F.col("n_nationkey").alias("c_nationkey"), F.lower(F.col("r_name")).alias("region"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                           "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    od = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    cu = t.customer.select("c_custkey", "c_nationkey").join(F.broadcast(geo), "c_nationkey")  # 25 rows
    pa = t.part.select("p_partkey", "p_name", "p_brand")
    oc = od.join(cu, F.col("o_custkey") == F.col("c_custkey"))      # orders meet their customers first, the lines follow
    rows = t.lineitem.count()       # from the files' footers
    lines = spread(li, rows, "l_orderkey").join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
    j = spread(lines, rows, "l_partkey").join(spread(pa, rows, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("video_id"),
        F.date_format("l_shipdate", "yy.dd.MM").alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("channel_title"),
        F.col("l_partkey").alias("category_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publish_time"),
        F.concat_ws("|", F.col("p_brand"), F.col("p_name")).alias("tags"),
        F.col("l_extendedprice").cast("long").alias("views"),
        F.col("l_quantity").cast("long").alias("likes"),
        F.round(F.col("l_discount") * 100).cast("long").alias("dislikes"),
        F.col("l_linenumber").cast("long").alias("comment_count"),
        F.concat(F.lit("https://img.example/"), F.col("l_orderkey").cast("string")).alias("thumbnail_link"),
        (F.col("l_returnflag") == "R").alias("comments_disabled"),
        (F.col("l_linestatus") == "O").alias("ratings_disabled"),
        F.lit(False).alias("video_error_or_removed"),
        F.col("p_name").alias("description"),
        "region",
    )


def categories(t: Tables) -> DataFrame:
    """Category reference rows ``(id, snippet_title)``: part key -> part type; dealt as the videos that look them up."""
    return spread(t.part, t.lineitem.count(), "p_partkey").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("snippet_title"))


def coins(t: Tables, asof: str = ASOF) -> DataFrame:
    """Market snapshot rows (13 raw fields) derived from ``part``.

    market cap = retail price * size * 1e7, so the tiers spread over Mid..Mega.
    """
    p = t.part
    ath_ts = F.lit(asof).cast("timestamp") - F.make_interval(days=F.col("p_size"), hours=F.col("p_size") % 24)
    return p.select(
        F.concat(F.lit("coin-"), F.col("p_partkey").cast("string")).alias("id"),
        F.lower(F.regexp_replace("p_brand", "#", "")).alias("symbol"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("name"),
        F.col("p_retailprice").alias("current_price"),
        (F.col("p_retailprice") * F.col("p_size") * F.lit(1e7)).alias("market_cap"),
        (F.col("p_retailprice") * F.lit(1e6)).alias("total_volume"),
        (F.col("p_retailprice") * 1.05).alias("high_24h"),
        (F.col("p_retailprice") * 0.95).alias("low_24h"),
        (F.col("p_size") - 25).cast("double").alias("price_change_percentage_24h"),
        (F.col("p_size") * F.lit(1e6)).alias("circulating_supply"),
        (F.col("p_retailprice") * 2).alias("ath"),
        F.date_format(ath_ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("ath_date"),
        F.date_format(F.lit(asof).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("last_updated"),
    )


def readings(t: Tables) -> DataFrame:
    """Sensor stream records from ``events``: station = user, parameter = event
    type, value = value, stream time = ts, 4 shards by user, sequence = event id."""
    e = t.events
    return e.select(
        F.col("user_id").cast("string").alias("location_id"),
        F.concat(F.lit("station-"), F.col("user_id").cast("string")).alias("location_name"),
        F.col("event_type").alias("parameter_of_AQI"),
        F.col("value").alias("value_of_AQI"),
        F.lit("ppm").alias("unit"),
        F.lit("UTC").alias("timezone"),
        (F.col("user_id") / 10.0).alias("latitude"),
        (F.col("user_id") / -10.0).alias("longitude"),
        F.lit("XX").alias("country_iso"),
        F.lit(None).cast("boolean").alias("isMobile"),
        F.lit(None).cast("boolean").alias("isMonitor"),
        F.lit("owner").alias("owner_name"),
        F.lit("provider").alias("provider"),
        F.col("ts").cast("timestamp").alias("processing_time"),
        F.concat(F.lit("shard-"), (F.col("user_id") % 4).cast("string")).alias("shard_id"),
        F.col("event_id").cast("string").alias("sequence_number"),
    )
