"""Registered batch queries: star schema and models, gold aggregates, columns,
joins, ranks, quality.  Each function is ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import star as S
from tidewater.plans import standins as SI
from tidewater.plans.flows import rides
from tidewater.plans.registry import register, rounded

# ============================================================== P3 ride star
TRIPS_SQL = """
trips AS (
  SELECT o.o_orderstatus AS vendor_id, o.o_orderpriority AS payment_type,
         rc.r_name AS pickup_city, nc.n_name AS pickup_location,
         rs.r_name AS dropoff_city, ns.n_name AS dropoff_location,
         o.o_orderdate AS pickup_datetime, l.l_quantity AS trip_distance,
         l.l_extendedprice * (1 - l.l_discount) AS fare_amount,
         l.l_extendedprice * l.l_tax AS tolls_amount, l.l_extendedprice AS total_amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN region rc ON nc.n_regionkey = rc.r_regionkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN region rs ON ns.n_regionkey = rs.r_regionkey),
dim_vendor AS (
  SELECT vendor_id, CAST(dense_rank() OVER (ORDER BY vendor_id NULLS FIRST) AS BIGINT) AS vendor_key
  FROM (SELECT DISTINCT vendor_id FROM trips)),
dim_payment AS (
  SELECT payment_type, CAST(dense_rank() OVER (ORDER BY payment_type NULLS FIRST) AS BIGINT) AS payment_key
  FROM (SELECT DISTINCT payment_type FROM trips)),
dim_location AS (
  SELECT pickup_city, pickup_location, dropoff_city, dropoff_location,
         CAST(row_number() OVER (ORDER BY pickup_city NULLS FIRST, pickup_location NULLS FIRST,
                                 dropoff_city NULLS FIRST, dropoff_location NULLS FIRST) AS BIGINT) AS location_key
  FROM (SELECT DISTINCT pickup_city, pickup_location, dropoff_city, dropoff_location FROM trips)),
facts AS (
  SELECT v.vendor_key, p.payment_key, lo.location_key, CAST(t.pickup_datetime AS DATE) AS trip_date,
         count(*) AS total_trips, sum(t.total_amount) AS total_revenue,
         avg(t.trip_distance) AS avg_distance, avg(t.fare_amount) AS avg_fare,
         sum(t.tolls_amount) AS total_tolls
  FROM trips t
  LEFT JOIN dim_vendor v ON t.vendor_id = v.vendor_id
  LEFT JOIN dim_payment p ON t.payment_type = p.payment_type
  LEFT JOIN dim_location lo ON t.pickup_city = lo.pickup_city AND t.pickup_location = lo.pickup_location
       AND t.dropoff_city = lo.dropoff_city AND t.dropoff_location = lo.dropoff_location
  GROUP BY 1, 2, 3, 4)
"""


def _star(spark, sf, method="hash"):
    t = SI.Tables(spark, sf)
    g = rides.grain(SI.trips(t))
    dims = rides.dimensions(g, method)
    return g, dims, rides.fact(g, dims if method == "rank" else None)


@register("m1_dim_vendor", f"WITH {TRIPS_SQL} SELECT * FROM dim_vendor")
def m1_dim_vendor(spark, sf):
    return S.build_dim(SI.trips(SI.Tables(spark, sf)), ["vendor_id"], "vendor_key")


@register("m1_dim_payment", f"WITH {TRIPS_SQL} SELECT * FROM dim_payment")
def m1_dim_payment(spark, sf):
    return S.build_dim(SI.trips(SI.Tables(spark, sf)), ["payment_type"], "payment_key")


@register("m2_dim_location", f"WITH {TRIPS_SQL} SELECT * FROM dim_location")
def m2_dim_location(spark, sf):
    return S.build_dim(SI.trips(SI.Tables(spark, sf)), rides.LOCATION_COLS, "location_key")


@register("m1_dim_hash_keys", f"""WITH {TRIPS_SQL}
SELECT count(*) AS n_keys, count(DISTINCT location_key) AS n_distinct FROM dim_location""")
def m1_dim_hash_keys(spark, sf):
    d = S.build_dim(SI.trips(SI.Tables(spark, sf)), rides.LOCATION_COLS, "location_key", method="hash")
    return d.agg(F.count(F.lit(1)).alias("n_keys"), F.countDistinct("location_key").alias("n_distinct"))


@register("m3_fact_trips", f"""WITH {TRIPS_SQL}
SELECT vendor_key, payment_key, location_key, trip_date, total_trips,
       round(total_revenue, 4) AS total_revenue, round(avg_distance, 4) AS avg_distance,
       round(avg_fare, 4) AS avg_fare, round(total_tolls, 4) AS total_tolls
FROM facts""")
def m3_fact_trips(spark, sf):
    return rounded(_star(spark, sf, "rank")[2])


@register("p3_total_revenue", f"""WITH {TRIPS_SQL}
SELECT v.vendor_id, round(sum(f.total_revenue), 4) AS revenue
FROM facts f JOIN dim_vendor v ON f.vendor_key = v.vendor_key
GROUP BY v.vendor_id ORDER BY revenue DESC""")
def p3_total_revenue(spark, sf):
    _, dims, facts = _star(spark, sf)
    return rounded(rides.total_revenue(facts, dims["dim_vendor"]))


@register("p3_revenue_by_payment", f"""WITH {TRIPS_SQL}
SELECT p.payment_type, round(sum(f.total_revenue), 4) AS revenue
FROM facts f JOIN dim_payment p ON f.payment_key = p.payment_key
GROUP BY p.payment_type ORDER BY revenue DESC""")
def p3_revenue_by_payment(spark, sf):
    _, dims, facts = _star(spark, sf)
    return rounded(rides.revenue_by_payment(facts, dims["dim_payment"]))


@register("p3_daily_avg_fare", f"""WITH {TRIPS_SQL}
SELECT trip_date, round(avg(avg_fare), 4) AS avg_daily_fare FROM facts GROUP BY trip_date ORDER BY trip_date""")
def p3_daily_avg_fare(spark, sf):
    return rounded(rides.daily_avg_fare(_star(spark, sf)[2]))


@register("p3_daily_avg_fare_weighted", f"""WITH {TRIPS_SQL}
SELECT trip_date, round(sum(avg_fare * total_trips) / sum(total_trips), 4) AS avg_daily_fare
FROM facts GROUP BY trip_date ORDER BY trip_date""")
def p3_daily_avg_fare_weighted(spark, sf):
    return rounded(rides.daily_avg_fare(_star(spark, sf)[2], weighted=True))


@register("p3_top_routes", f"""WITH {TRIPS_SQL}
SELECT l.pickup_location, l.dropoff_location, round(sum(f.total_revenue), 4) AS revenue,
       CAST(sum(f.total_trips) AS BIGINT) AS trips
FROM facts f JOIN dim_location l ON f.location_key = l.location_key
GROUP BY l.pickup_location, l.dropoff_location
ORDER BY sum(f.total_revenue) DESC, l.pickup_location, l.dropoff_location LIMIT 10""")
def p3_top_routes(spark, sf):
    _, dims, facts = _star(spark, sf)
    return rounded(rides.top_routes(facts, dims["dim_location"]))


def _count_test(name, from_where):
    return (f"SELECT '{name}' AS test_name, count(*) AS failures, "
            f"CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {from_where}")


@register("p3_model_tests", f"""WITH {TRIPS_SQL}
{_count_test('not_null_dim_vendor_vendor_id', 'dim_vendor WHERE vendor_id IS NULL')}
UNION ALL {_count_test('unique_dim_vendor_vendor_key',
                       '(SELECT vendor_key FROM dim_vendor GROUP BY 1 HAVING count(*) > 1)')}
UNION ALL {_count_test('not_null_dim_vendor_vendor_key', 'dim_vendor WHERE vendor_key IS NULL')}
UNION ALL {_count_test('relationships_facts_vendor_key',
                       'facts f WHERE f.vendor_key IS NOT NULL AND NOT EXISTS '
                       '(SELECT 1 FROM dim_vendor v WHERE v.vendor_key = f.vendor_key)')}
UNION ALL {_count_test('no_negative_revenue', 'facts WHERE total_revenue < 0')}""")
def p3_model_tests(spark, sf):
    _, dims, facts = _star(spark, sf)
    return rides.model_tests(facts, dims["dim_vendor"])


# ============================================================== P4 medallion gold
VIDEOS_SQL = """
videos AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS video_id,
         strftime(l.l_shipdate, '%y.%d.%m') AS trending_date,
         p.p_name AS title, p.p_brand AS channel_title, l.l_partkey AS category_id,
         CAST(trunc(l.l_extendedprice) AS BIGINT) AS views,
         CAST(trunc(l.l_quantity) AS BIGINT) AS likes,
         CAST(round(l.l_discount * 100) AS BIGINT) AS dislikes,
         CAST(l.l_linenumber AS BIGINT) AS comment_count,
         l.l_returnflag = 'R' AS comments_disabled,
         lower(r.r_name) AS region
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey),
stats AS (
  SELECT v.*, coalesce(cat.category_name, 'Unknown') AS category_name,
         make_date(2000 + CAST(substr(v.trending_date, 1, 2) AS INTEGER),
                   CAST(substr(v.trending_date, 7, 2) AS INTEGER),
                   CAST(substr(v.trending_date, 4, 2) AS INTEGER)) AS trending_date_parsed,
         CASE WHEN v.likes + v.dislikes > 0 THEN CAST(v.likes AS DOUBLE) / (v.likes + v.dislikes) END AS like_ratio,
         CASE WHEN v.views > 0 THEN CAST(v.likes + v.dislikes + v.comment_count AS DOUBLE) / v.views END
           AS engagement_rate
  FROM videos v
  LEFT JOIN (SELECT p_partkey AS id, min(p_type) AS category_name FROM part GROUP BY p_partkey) cat
    ON v.category_id = cat.id),
trending AS (
  SELECT region, trending_date_parsed, count(video_id) AS total_videos,
         CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(dislikes) AS BIGINT) AS total_dislikes, CAST(sum(comment_count) AS BIGINT) AS total_comments,
         avg(views) AS avg_views_per_video, avg(like_ratio) AS avg_like_ratio,
         avg(engagement_rate) AS avg_engagement_rate, max(views) AS max_views,
         count(DISTINCT channel_title) AS unique_channels, count(DISTINCT category_id) AS unique_categories
  FROM stats GROUP BY region, trending_date_parsed),
channels AS (
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS rank_in_region
  FROM (
    SELECT channel_title, region, count(DISTINCT video_id) AS total_videos,
           CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
           CAST(sum(comment_count) AS BIGINT) AS total_comments, avg(views) AS avg_views_per_video,
           avg(engagement_rate) AS avg_engagement_rate, max(views) AS peak_views,
           count(trending_date_parsed) AS times_trending, min(trending_date_parsed) AS first_trending,
           max(trending_date_parsed) AS last_trending, list_sort(list(DISTINCT category_name)) AS categories
    FROM stats GROUP BY channel_title, region)),
categories AS (
  SELECT *, round(CAST(total_views AS DOUBLE) / sum(total_views) OVER (PARTITION BY region, trending_date_parsed)
                  * 100, 2) AS view_share_pct
  FROM (
    SELECT category_name, category_id, region, trending_date_parsed, count(video_id) AS video_count,
           CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
           CAST(sum(comment_count) AS BIGINT) AS total_comments, avg(engagement_rate) AS avg_engagement_rate,
           count(DISTINCT channel_title) AS unique_channels
    FROM stats GROUP BY category_name, category_id, region, trending_date_parsed))
"""


def _stats(spark, sf):
    from tidewater.plans.flows import medallion as M
    t = SI.Tables(spark, sf)
    return M.enriched(M.silver(SI.videos(t)), SI.categories(t))


def _gold(spark, sf, which):
    from tidewater.plans.flows import medallion as M
    return getattr(M, which)(_stats(spark, sf))


@register("p4_trending_daily", f"""WITH {VIDEOS_SQL}
SELECT region, trending_date_parsed, total_videos, total_views, total_likes, total_dislikes, total_comments,
       round(avg_views_per_video, 4) AS avg_views_per_video, round(avg_like_ratio, 4) AS avg_like_ratio,
       round(avg_engagement_rate, 4) AS avg_engagement_rate, max_views, unique_channels, unique_categories
FROM trending""")
def p4_trending_daily(spark, sf):
    return rounded(_gold(spark, sf, "trending_daily"))


@register("p4_channel_summary", f"""WITH {VIDEOS_SQL}
SELECT channel_title, region, total_videos, total_views, total_likes, total_comments,
       round(avg_views_per_video, 4) AS avg_views_per_video, round(avg_engagement_rate, 4) AS avg_engagement_rate,
       peak_views, times_trending, first_trending, last_trending, categories, rank_in_region
FROM channels""")
def p4_channel_summary(spark, sf):
    return rounded(_gold(spark, sf, "channel_summary"))


@register("p4_category_daily", f"""WITH {VIDEOS_SQL}
SELECT category_name, category_id, region, trending_date_parsed, video_count, total_views, total_likes,
       total_comments, round(avg_engagement_rate, 4) AS avg_engagement_rate, unique_channels, view_share_pct
FROM categories""")
def p4_category_daily(spark, sf):
    return rounded(_gold(spark, sf, "category_daily"))


@register("e10_channels_in_regions", f"""WITH {VIDEOS_SQL}
SELECT channel_title, count(DISTINCT region) AS regions, CAST(sum(total_views) AS BIGINT) AS total_views_global
FROM channels GROUP BY channel_title HAVING count(DISTINCT region) >= 3
ORDER BY total_views_global DESC, channel_title LIMIT 20""")
def e10_channels_in_regions(spark, sf):
    from tidewater.plans.flows import medallion as M
    return M.channels_in_regions(_gold(spark, sf, "channel_summary"))


@register("e11_category_by_region", f"""WITH {VIDEOS_SQL}
SELECT category_name, region, CAST(sum(total_views) AS BIGINT) AS total_views,
       CAST(sum(video_count) AS BIGINT) AS video_count
FROM categories GROUP BY category_name, region ORDER BY total_views DESC, category_name, region LIMIT 50""")
def e11_category_by_region(spark, sf):
    from tidewater.plans.flows import medallion as M
    return M.category_by_region(_gold(spark, sf, "category_daily"))


@register("e12_like_ratio_by_region", f"""WITH {VIDEOS_SQL}
SELECT region, round(avg(avg_like_ratio), 4) AS avg_like_ratio_across_days FROM trending GROUP BY region""")
def e12_like_ratio_by_region(spark, sf):
    from tidewater.plans.flows import medallion as M
    return rounded(M.like_ratio_by_region(_gold(spark, sf, "trending_daily")))


DASH_INPUT = {"views_by_category": "categories", "engagement_heatmap": "categories", "videos_by_region": "trending",
              "views_by_date": "trending", "kpis": "trending", "top_channels": "channels"}


def _dash(spark, sf, part):
    from tidewater.plans.flows import medallion as M
    st = _stats(spark, sf)
    build = {"categories": M.category_daily, "trending": M.trending_daily, "channels": M.channel_summary}
    src = DASH_INPUT[part]
    return M.dashboard(**{src: build[src](st)})[part]


@register("e18_views_by_category", f"""WITH {VIDEOS_SQL}
SELECT category_name, CAST(sum(total_views) AS BIGINT) AS total_views FROM categories GROUP BY category_name""")
def e18_views_by_category(spark, sf):
    return _dash(spark, sf, "views_by_category")


@register("e18_videos_by_region", f"""WITH {VIDEOS_SQL}
SELECT region, CAST(sum(total_videos) AS BIGINT) AS video_count FROM trending GROUP BY region""")
def e18_videos_by_region(spark, sf):
    return _dash(spark, sf, "videos_by_region")


@register("e18_views_by_date", f"""WITH {VIDEOS_SQL}
SELECT trending_date_parsed, CAST(sum(total_views) AS BIGINT) AS total_views FROM trending GROUP BY 1""")
def e18_views_by_date(spark, sf):
    return _dash(spark, sf, "views_by_date")


@register("e18_top_channels", f"""WITH {VIDEOS_SQL}
SELECT channel_title, CAST(sum(total_views) AS BIGINT) AS total_views FROM channels GROUP BY channel_title
ORDER BY total_views DESC, channel_title LIMIT 10""")
def e18_top_channels(spark, sf):
    return _dash(spark, sf, "top_channels")


@register("e18_kpis", f"""WITH {VIDEOS_SQL}
SELECT CAST(sum(total_videos) AS BIGINT) AS total_videos, round(sum(total_views) / sum(total_videos), 4) AS avg_views,
       round(sum(total_likes) / sum(total_videos), 4) AS avg_likes FROM trending""")
def e18_kpis(spark, sf):
    return rounded(_dash(spark, sf, "kpis"))


@register("e18_engagement_heatmap", f"""WITH {VIDEOS_SQL}
SELECT region, category_name, round(avg(avg_engagement_rate), 4) AS avg_engagement_rate
FROM categories GROUP BY region, category_name""")
def e18_engagement_heatmap(spark, sf):
    """Region x category heat map in long form; ``dashboard()`` also offers the pivot."""
    from tidewater.plans.flows import medallion as M
    c = M.category_daily(_stats(spark, sf))
    return rounded(c.groupBy("region", "category_name").agg(F.avg("avg_engagement_rate").alias("avg_engagement_rate")))


# The categories that the heat map shows.
HEATMAP_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_PIVOT_SQL = ", ".join(f"""round(avg(CASE WHEN category_name = '{c}' THEN avg_engagement_rate END), 4) AS "{c}\"""" for c in HEATMAP_CATEGORIES)


@register("e18_engagement_pivot", f"WITH {VIDEOS_SQL} SELECT region, count(*) AS cells, {_PIVOT_SQL} FROM categories GROUP BY region")
def e18_engagement_pivot(spark, sf):
    """The heat map as a pivot (one column for each listed category)."""
    from tidewater.plans.flows import medallion as M
    return rounded(M.dashboard(M.category_daily(_stats(spark, sf)), names=HEATMAP_CATEGORIES)["engagement_heatmap"])
