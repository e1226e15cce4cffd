"""Registered operator-level queries: columns (2C, 2I), joins (2D), aggregates
(2E), ranks and shares (2F), sorts and unions (2G, 2H), quality (2L) and the
market snapshot split (M4, M5).  Each function is ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.operators import quality as Q
from tidewater.operators import relational as R
from tidewater.operators import star as S
from tidewater.plans import standins as SI
from tidewater.plans.registry import register, rounded
from tidewater.session import scratch_dir

ASOF = SI.ASOF


def T(spark, sf):
    return SI.Tables(spark, sf)


# ============================================================== 2C projections and filters
@register("c1_keep_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def c1_keep_columns(spark, sf):
    return T(spark, sf).customer.select("c_custkey", "c_name", "c_acctbal")


@register("c2_rename", """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total_amount, o_orderdate AS order_datetime, o_orderpriority AS priority FROM orders""")
def c2_rename(spark, sf):
    return T(spark, sf).orders.withColumnsRenamed({
        "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "status",
        "o_totalprice": "total_amount", "o_orderdate": "order_datetime", "o_orderpriority": "priority"})


@register("c3_drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def c3_drop(spark, sf):
    return T(spark, sf).orders.drop("o_totalprice", "o_orderpriority")


@register("c4_apply_mapping", """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS line,
       TRY_CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship_date,
       CAST(NULL AS VARCHAR) AS comment FROM lineitem""")
def c4_apply_mapping(spark, sf):
    return C.apply_mapping(T(spark, sf).lineitem, [
        ("l_orderkey", "long", "order_id", "string"),
        ("L_LINENUMBER", "int", "line", "long"),
        ("l_quantity", "double", "quantity", "long"),
        ("l_returnflag", "string", "flag", "string"),
        ("l_shipdate", "timestamp", "ship_date", "date"),
        ("l_comment", "string", "comment", "string"),   # absent -> typed null
    ])


MIXED_SQL = ("CASE WHEN event_type = 'error' THEN 'e' || json_extract_string(props, '$.k') "
             "ELSE json_extract_string(props, '$.k') END")


def _mixed(e):
    k = F.get_json_object("props", "$.k")
    return F.when(F.col("event_type") == "error", F.concat(F.lit("e"), k)).otherwise(k)


@register("c5_resolve_choice", f"""SELECT event_id, TRY_CAST({MIXED_SQL} AS BIGINT) AS value_long,
       CASE WHEN TRY_CAST({MIXED_SQL} AS BIGINT) IS NULL THEN {MIXED_SQL} END AS value_string FROM events""")
def c5_resolve_choice(spark, sf):
    e = T(spark, sf).events
    r = e.select("event_id", C.resolve_choice(_mixed(e), ["long", "string"]).alias("v"))
    return r.select("event_id", F.col("v.long").alias("value_long"), F.col("v.string").alias("value_string"))


@register("c6_drop_null_fields", "SELECT * FROM orders")
def c6_drop_null_fields(spark, sf):
    o = T(spark, sf).orders.withColumn("o_comment", F.lit(None).cast("string"))
    return C.drop_null_fields(o)


# Order status labels used as the CASE WHEN stand-in.
STATUS_LABELS = {"F": "Finished", "O": "Open", "P": "Pending"}


@register("c7_case_label", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Finished'
       WHEN o_orderstatus = 'O' THEN 'Open' WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Other' END AS status_label
FROM orders""")
def c7_case_label(spark, sf):
    o = T(spark, sf).orders
    return o.select("o_orderkey", C.case_label("o_orderstatus", STATUS_LABELS, "Other").alias("status_label"))


@register("c8_predicates", """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus IN ('F', 'O') AND l_quantity > 10 AND l_discount < 0.05
  AND l_tax >= 0.02 AND l_shipdate IS NOT NULL""")
def c8_predicates(spark, sf):
    li = T(spark, sf).lineitem
    return (li.where((F.col("l_returnflag") == "R") & F.col("l_linestatus").isin("F", "O")
                     & (F.col("l_quantity") > 10) & (F.col("l_discount") < 0.05)
                     & (F.col("l_tax") >= 0.02) & F.col("l_shipdate").isNotNull())
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"))


@register("c9_ensure_column", """SELECT o_orderkey, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority,
       'none' AS o_comment FROM orders""")
def c9_ensure_column(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    o = C.ensure_column(o, "o_orderpriority", "Unknown")
    return C.ensure_column(o, "o_comment", "none")


@register("c10_zero_if_null", """SELECT l_orderkey, l_linenumber,
       round(l_extendedprice * (1 + coalesce(CASE WHEN l_tax > 0.04 THEN l_tax END, 0)), 4) AS gross
FROM lineitem""")
def c10_zero_if_null(spark, sf):
    li = T(spark, sf).lineitem
    tax = F.when(F.col("l_tax") > 0.04, F.col("l_tax"))   # null for low tax rows
    return rounded(li.select("l_orderkey", "l_linenumber",
                             (F.col("l_extendedprice") * (1 + C.zero_if_null(tax))).alias("gross")))


@register("c11_normalise_keys", """SELECT n_nationkey, trim(lower(k)) AS key
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey,
     unnest(string_split(' ' || upper(n.n_name) || ' , ' || r.r_name || ' ', ',')) AS t(k)""")
def c11_normalise_keys(spark, sf):
    t = T(spark, sf)
    nr = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    raw = F.concat(F.lit(" "), F.upper("n_name"), F.lit(" , "), F.col("r_name"), F.lit(" "))
    return nr.select("n_nationkey", F.explode(C.split_keys(raw, ",")).alias("key"))


ENRICH_SQL = """SELECT CAST(user_id AS VARCHAR) AS location_id, 'station-' || CAST(user_id AS VARCHAR) AS location_name,
       event_type AS parameter_of_AQI, value AS value_of_AQI, 'ppm' AS unit, 'UTC' AS timezone,
       user_id / 10.0 AS latitude, user_id / -10.0 AS longitude, 'XX' AS country_iso,
       CAST(NULL AS BOOLEAN) AS isMobile, CAST(NULL AS BOOLEAN) AS isMonitor, 'owner' AS owner_name,
       'provider' AS provider, upper(event_type) AS parameter_uppercase,
       round(value * 1.8 + 32, 4) AS value_in_fahrenheit FROM events"""


@register("c12_enrich", ENRICH_SQL)
def c12_enrich(spark, sf):
    from tidewater.streaming.streams import enrich
    return rounded(enrich(SI.readings(T(spark, sf))))


# ============================================================== 2I scalar functions
@register("i1_upper", "SELECT event_id, upper(event_type) AS event_type_upper FROM events")
def i1_upper(spark, sf):
    return T(spark, sf).events.select("event_id", F.upper("event_type").alias("event_type_upper"))


@register("i2_title_case", r"""SELECT p_partkey, array_to_string(list_transform(
         regexp_extract_all(trim(' ' || p_name || '-x1y o''k '), '\p{L}+|[^\p{L}]+'),
         lambda r: upper(r[1]) || lower(r[2:])), '') AS title FROM part""")
def i2_title_case(spark, sf):
    p = T(spark, sf).part
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit("-x1y o'k "))
    return p.select("p_partkey", C.title_case(raw).alias("title"))


@register("i3_tier_strict", """SELECT p_partkey, CASE WHEN coalesce(p_retailprice * p_size * 1e7, 0) > 100000000000 THEN 'Mega'
       WHEN coalesce(p_retailprice * p_size * 1e7, 0) > 10000000000 THEN 'Large'
       WHEN coalesce(p_retailprice * p_size * 1e7, 0) > 1000000000 THEN 'Mid' ELSE 'Small' END AS tier FROM part""")
def i3_tier_strict(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", C.tier_strict(F.col("p_retailprice") * F.col("p_size") * F.lit(1e7)).alias("tier"))


@register("i4_tier_bins", """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_acctbal <= 1000 THEN 'Small'
       WHEN c_acctbal > 1000 AND c_acctbal <= 5000 THEN 'Mid' WHEN c_acctbal > 5000 AND c_acctbal <= 9000 THEN 'Large'
       WHEN c_acctbal > 9000 THEN 'Mega' END AS tier FROM customer""")
def i4_tier_bins(spark, sf):
    c = T(spark, sf).customer
    # bins scaled to account balances (the default edges are market-cap sized)
    return c.select("c_custkey", C.tier_bins("c_acctbal", (0.0, 1000.0, 5000.0, 9000.0, float("inf"))).alias("tier"))


@register("i5_safe_ratio", """SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount <> 0 THEN round(l_tax / l_discount, 4) END AS tax_per_discount FROM lineitem""")
def i5_safe_ratio(spark, sf):
    li = T(spark, sf).lineitem
    return rounded(li.select("l_orderkey", "l_linenumber", C.safe_ratio("l_tax", "l_discount").alias("tax_per_discount")))


@register("i6_rounded_diff", """SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_quantity, 2) AS diff
FROM lineitem""")
def i6_rounded_diff(spark, sf):
    li = T(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", C.rounded_diff("l_extendedprice", "l_quantity", 2).alias("diff"))


@register("i7_days_since", f"""SELECT o_orderkey, CAST(floor((epoch_us(TIMESTAMP '{ASOF}') - epoch_us(o_orderdate))
       / 86400000000) AS INTEGER) AS days_since, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE
       CAST(floor((epoch_us(TIMESTAMP '{ASOF}') - epoch_us(o_orderdate)) / 86400000000) AS INTEGER) END AS days_since_text
FROM orders""")
def i7_days_since(spark, sf):
    """Instants and instant text; text that is no instant gives null."""
    o = T(spark, sf).orders
    text = F.when(F.col("o_orderstatus") == "F", F.lit("soon")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return o.select("o_orderkey", C.days_since("o_orderdate", ASOF).alias("days_since"), C.days_since(text, ASOF).alias("days_since_text"))


@register("i8_parse_instant", """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS parsed,
       CAST(NULL AS VARCHAR) AS parsed_bad FROM orders""")
def i8_parse_instant(spark, sf):
    o = T(spark, sf).orders
    iso = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return o.select("o_orderkey",
                    F.date_format(C.parse_instant(iso), "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                    F.date_format(C.parse_instant(F.concat(iso, F.lit("garbage"))), "yyyy").alias("parsed_bad"))


@register("i9_parse_yy_dd_mm", """SELECT o_orderkey, make_date(2000 + CAST(strftime(o_orderdate, '%y') AS INTEGER),
       month(o_orderdate), day(o_orderdate)) AS parsed, CAST(NULL AS DATE) AS parsed_bad FROM orders""")
def i9_parse_yy_dd_mm(spark, sf):
    o = T(spark, sf).orders
    txt = F.date_format("o_orderdate", "yy.dd.MM")
    return o.select("o_orderkey", C.parse_yy_dd_mm(txt).alias("parsed"),
                    C.parse_yy_dd_mm(F.concat(F.lit("x"), txt)).alias("parsed_bad"))


@register("i10_to_date", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS text_date FROM orders""")
def i10_to_date(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", F.lit("no day")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return T(spark, sf).orders.select("o_orderkey", C.to_day("o_orderdate").alias("order_date"), C.to_day(text).alias("text_date"))


@register("i11_positive_ratio", """SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity + round(l_discount * 100) > 0
            THEN round(l_quantity / (l_quantity + round(l_discount * 100)), 4) END AS like_ratio,
       CASE WHEN l_extendedprice > 0 THEN round((l_quantity + l_linenumber) / l_extendedprice, 4) END AS engagement
FROM lineitem""")
def i11_positive_ratio(spark, sf):
    li = T(spark, sf).lineitem
    dis = F.round(F.col("l_discount") * 100)
    return rounded(li.select("l_orderkey", "l_linenumber",
                             C.positive_ratio("l_quantity", F.col("l_quantity") + dis).alias("like_ratio"),
                             C.positive_ratio(F.col("l_quantity") + F.col("l_linenumber"), "l_extendedprice")
                             .alias("engagement")))


@register("i12_rescale", "SELECT event_id, round(value * 1.8 + 32, 4) AS rescaled FROM events")
def i12_rescale(spark, sf):
    return rounded(T(spark, sf).events.select("event_id", C.rescale("value").alias("rescaled")))


@register("i13_parse_fields", r"""SELECT event_id, nullif(regexp_extract(props, '"k":\s*(\d+)', 1), '') AS k,
       nullif(regexp_extract(props, '"z":\s*(\d+)', 1), '') AS z FROM events""")
def i13_parse_fields(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", *C.parse_fields("props", r'"k":\s*(\d+)', ["k"]),
                    *C.parse_fields("props", r'"z":\s*(\d+)', ["z"]))


@register("i14_row_to_json", """SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, event_type := event_type,
       user_id := user_id)) AS VARCHAR) AS message FROM events""")
def i14_row_to_json(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", C.row_to_json("event_id", "event_type", "user_id").alias("message"))


@register("i15_run_stamps", """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS stamp_compact,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp_iso, strftime(ts, '%Y%m%d_%H%M%S') AS stamp_underscore,
       strftime(ts, '%Y-%m-%d') AS stamp_date, strftime(ts, '%H') AS stamp_hour FROM events""")
def i15_run_stamps(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", *C.run_stamps("ts"))


@register("i16_aggregated_at", "SELECT o_orderstatus, count(*) AS n, true AS stamped_now FROM orders GROUP BY 1")
def i16_aggregated_at(spark, sf):
    """The stamp is the run's own instant: one for all rows, and within a day of the driver's clock."""
    o = T(spark, sf).orders
    now = datetime.now(timezone.utc)
    out = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("_aggregated_at", F.current_timestamp())
    return out.select("o_orderstatus", "n", (F.abs(F.unix_seconds("_aggregated_at") - F.lit(int(now.timestamp()))) < 86_400).alias("stamped_now"))


@register("i17_minus_interval", f"""SELECT count(*) AS recent FROM events
WHERE ts >= TIMESTAMP '{ASOF}' - INTERVAL 48 HOUR""")
def i17_minus_interval(spark, sf):
    e = T(spark, sf).events
    cutoff = C.minus_interval(F.lit(ASOF).cast("timestamp_ntz"), "48 hours")
    return e.where(F.col("ts") >= cutoff).agg(F.count(F.lit(1)).alias("recent"))


@register("i18_tolerant_cast", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(event_type AS INTEGER) AS bad FROM events""")
def i18_tolerant_cast(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", C.tolerant_cast(F.get_json_object("props", "$.k"), "int").alias("k"),
                    C.tolerant_cast("event_type", "int").alias("bad"))


@register("i19_basename", "SELECT page_id, string_split(url, '/')[-1] AS base FROM pages")
def i19_basename(spark, sf):
    return T(spark, sf).pages.select("page_id", C.file_basename("url").alias("base"))


@register("i20_url_decode", """SELECT page_id, url_decode(replace(replace(url, '?', '%3F'), '&', '%26')) AS decoded
FROM pages""")
def i20_url_decode(spark, sf):
    p = T(spark, sf).pages
    enc = F.replace(F.replace(F.col("url"), F.lit("?"), F.lit("%3F")), F.lit("&"), F.lit("%26"))
    return p.select("page_id", C.url_decode(enc).alias("decoded"))


@register("i21_time_bin", """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin, count(*) AS n FROM events GROUP BY 1""")
def i21_time_bin(spark, sf):
    e = T(spark, sf).events
    return e.groupBy(C.time_bin("ts", "5 minutes").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("a19_decode_payload", """SELECT event_id,
       CASE WHEN event_type = 'error' THEN CAST(to_json(struct_pack(raw := 'not json ' || CAST(event_id AS VARCHAR)))
            AS VARCHAR) ELSE props END AS payload FROM events""")
def a19_decode_payload(spark, sf):
    e = T(spark, sf).events
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), F.col("event_id").cast("string"))) \
        .otherwise(F.col("props"))
    encoded = F.base64(F.encode(text, "UTF-8"))
    return e.select("event_id", C.decode_payload(encoded).alias("payload"))


# ============================================================== 2D joins
@register("d1_lookup_left", """SELECT o.o_orderkey, coalesce(c.seg, 'UNKNOWN') AS segment
FROM orders o LEFT JOIN (SELECT c_custkey, min(c_mktsegment) AS seg FROM customer
                         WHERE c_custkey IS NOT NULL AND c_acctbal >= 0 GROUP BY c_custkey) c
  ON o.o_custkey = c.c_custkey""")
def d1_lookup_left(spark, sf):
    """Lookup keys are text, as a file would bring them: every key comes in two spellings, and there are
    keys that are no number; neither may double a fact row or fail."""
    t = T(spark, sf)
    # customers in debit are absent from the lookup, so the default is exercised
    dim = t.customer.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").cast("string"), "c_mktsegment")
    dim = dim.union(dim.select(F.concat(F.lit("0"), "c_custkey"), "c_mktsegment")).union(dim.select(F.concat(F.lit("x"), "c_custkey"), F.lit("BAD")))
    return R.lookup_left(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", "c_custkey",
                         {"c_mktsegment": "segment"}, {"segment": "UNKNOWN"}).select("o_orderkey", "segment")


@register("d1_lookup_missing_dim", "SELECT o_orderkey, 'UNKNOWN' AS segment FROM orders")
def d1_lookup_missing_dim(spark, sf):
    t = T(spark, sf)
    return R.lookup_left(t.orders.select("o_orderkey", "o_custkey"), None, "o_custkey", "c_custkey",
                         {"c_mktsegment": "segment"}, {"segment": "UNKNOWN"}).select("o_orderkey", "segment")


@register("d2_left_join", """SELECT o.o_orderkey, c.c_nationkey FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def d2_left_join(spark, sf):
    t = T(spark, sf)
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return R.left_join(o, t.customer.select("c_custkey", "c_nationkey"), "c_custkey").select("o_orderkey", "c_nationkey")


@register("d3_left_join_four_keys", """SELECT count(*) AS trips, count(lo.location_key) AS matched
FROM (SELECT nc.n_name AS a, rc.r_name AS b, CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE nc.n_name END AS c,
             rc.r_name AS d FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
             JOIN nation nc ON cu.c_nationkey = nc.n_nationkey JOIN region rc ON nc.n_regionkey = rc.r_regionkey) t
LEFT JOIN (SELECT n.n_name AS a, r.r_name AS b, n.n_name AS c, r.r_name AS d, n.n_nationkey AS location_key
           FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) lo
  ON t.a = lo.a AND t.b = lo.b AND t.c = lo.c AND t.d = lo.d""")
def d3_left_join_four_keys(spark, sf):
    t = T(spark, sf)
    geo = t.geo
    o = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
         .select(F.col("n_name").alias("a"), F.col("r_name").alias("b"),
                 F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("n_name")).alias("c"),
                 F.col("r_name").alias("d")))
    dim = geo.select(F.col("n_name").alias("a"), F.col("r_name").alias("b"), F.col("n_name").alias("c"),
                     F.col("r_name").alias("d"), F.col("n_nationkey").alias("location_key"))
    j = R.left_join(o, dim, ["a", "b", "c", "d"])
    return j.agg(F.count(F.lit(1)).alias("trips"), F.count("location_key").alias("matched"))


@register("d4_inner_join", """SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def d4_inner_join(spark, sf):
    t = T(spark, sf)
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return R.inner_join(o, t.customer.select("c_custkey", "c_name"), "c_custkey").select("o_orderkey", "c_name")


SNAP_SQL = """snap_id AS (SELECT user_id AS id, CAST(ts AS DATE) AS extracted_at, max(event_type) AS last_type
                         FROM events GROUP BY 1, 2),
snap_mkt AS (SELECT user_id AS id, CAST(ts AS DATE) AS extracted_at, round(sum(value), 4) AS total_value
             FROM events GROUP BY 1, 2),
snap_px AS (SELECT user_id AS id, CAST(ts AS DATE) AS extracted_at, count(*) AS n_events FROM events GROUP BY 1, 2)"""


def _snapshots(e):
    day = F.to_date("ts").alias("extracted_at")
    ident = e.groupBy(F.col("user_id").alias("id"), day).agg(F.max("event_type").alias("last_type"))
    mkt = e.groupBy(F.col("user_id").alias("id"), day).agg(F.round(F.sum("value"), 4).alias("total_value"))
    px = e.groupBy(F.col("user_id").alias("id"), day).agg(F.count(F.lit(1)).alias("n_events"))
    return ident, mkt, px


@register("d5_latest_snapshot_join", f"""WITH {SNAP_SQL}
SELECT i.id, i.extracted_at, i.last_type, m.total_value, p.n_events
FROM snap_id i JOIN snap_mkt m ON i.id = m.id AND i.extracted_at = m.extracted_at
JOIN snap_px p ON i.id = p.id AND i.extracted_at = p.extracted_at
WHERE i.extracted_at = (SELECT max(extracted_at) FROM snap_id)""")
def d5_latest_snapshot_join(spark, sf):
    ident, mkt, px = _snapshots(T(spark, sf).events)
    return rounded(R.latest_snapshot_join([ident, mkt, px]).select("id", "extracted_at", "last_type",
                                                                   "total_value", "n_events"))


@register("d6_join_extra_equality", f"""WITH {SNAP_SQL}
SELECT e.event_id, m.total_value FROM events e JOIN snap_mkt m ON e.user_id = m.id
WHERE CAST(e.ts AS DATE) = m.extracted_at""")
def d6_join_extra_equality(spark, sf):
    e = T(spark, sf).events
    _, mkt, _ = _snapshots(e)
    ee = e.select("event_id", F.col("user_id").alias("id"), F.to_date("ts").alias("extracted_at"))
    return rounded(R.inner_join(ee, mkt, ["id", "extracted_at"]).select("event_id", "total_value"))


@register("d7_join_id_only_fanout", f"""WITH {SNAP_SQL}
SELECT i.id, count(*) AS pairs FROM snap_id i JOIN snap_px p ON i.id = p.id GROUP BY i.id""")
def d7_join_id_only_fanout(spark, sf):
    ident, _, px = _snapshots(T(spark, sf).events)
    # an id's rows on either side meet in all pairs, so their number is a product; no pair is made
    a = ident.groupBy("id").agg(F.count(F.lit(1)).alias("a"))
    b = px.groupBy("id").agg(F.count(F.lit(1)).alias("b"))
    return R.inner_join(a, b, "id").select("id", (F.col("a") * F.col("b")).alias("pairs"))


# ============================================================== 2E aggregates
@register("e8_count_by_key", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def e8_count_by_key(spark, sf):
    return T(spark, sf).events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("e9_avg_non_null", """SELECT event_type, round(avg(CASE WHEN value < 5 THEN NULL ELSE value END), 4)
       AS avg_value FROM events WHERE (CASE WHEN value < 5 THEN NULL ELSE value END) IS NOT NULL
GROUP BY event_type""")
def e9_avg_non_null(spark, sf):
    e = T(spark, sf).events
    # readings under 5 are treated as missing, so the average runs over non-null values only
    v = F.when(F.col("value") < 5, None).otherwise(F.col("value")).alias("v")
    return rounded(e.select("event_type", v).where(F.col("v").isNotNull())
                   .groupBy("event_type").agg(F.avg("v").alias("avg_value")))


@register("e13_global_avg", "SELECT round(avg(value), 4) AS avg_value FROM events WHERE value IS NOT NULL")
def e13_global_avg(spark, sf):
    e = T(spark, sf).events
    return rounded(e.where(F.col("value").isNotNull()).agg(F.avg("value").alias("avg_value")))


ALL_TABLES_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in SI.TABLES)


@register("e14_h1_table_counts", ALL_TABLES_SQL)
def e14_h1_table_counts(spark, sf):
    t = T(spark, sf)
    return R.labelled_counts({name: getattr(t, name) for name in SI.TABLES})


@register("e15_bin_stats", """WITH c AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS window_end,
                       count(*) AS record_count FROM events GROUP BY 1)
SELECT time_bucket(INTERVAL 5 MINUTE, window_end) AS bin, max(record_count) AS max_rc, min(record_count) AS min_rc,
       round(avg(record_count), 4) AS avg_rc FROM c GROUP BY 1""")
def e15_bin_stats(spark, sf):
    e = T(spark, sf).events
    counts = e.groupBy(F.window("ts", "1 minute").end.alias("window_end")).agg(F.count(F.lit(1)).alias("record_count"))
    return rounded(counts.groupBy(C.time_bin("window_end", "5 minutes").alias("bin"))
                   .agg(F.max("record_count").alias("max_rc"), F.min("record_count").alias("min_rc"),
                        F.avg("record_count").alias("avg_rc")))


@register("e16_count_by_label", """SELECT nullif(regexp_extract(message, '"event_type":"([^"]+)"', 1), '') AS label,
       count(*) AS n
FROM (SELECT to_json(struct_pack(event_type := event_type, user_id := user_id)) AS message FROM events)
GROUP BY 1""")
def e16_count_by_label(spark, sf):
    e = T(spark, sf).events
    msg = e.select(C.row_to_json("event_type", "user_id").alias("message"))
    return (msg.select(*C.parse_fields("message", r'"event_type":"([^"]+)"', ["label"]))
            .groupBy("label").agg(F.count(F.lit(1)).alias("n")))


@register("e16_count_by_10min", "SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS bin, count(*) AS n FROM events GROUP BY 1")
def e16_count_by_10min(spark, sf):
    e = T(spark, sf).events
    return e.groupBy(C.time_bin("ts", "10 minutes").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("e17_distinct", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def e17_distinct(spark, sf):
    return R.distinct_rows(T(spark, sf).customer, ["c_nationkey", "c_mktsegment"])


@register("e17_dedup_latest", """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_totalprice DESC) AS rn
  FROM orders) WHERE rn = 1""")
def e17_dedup_latest(spark, sf):
    o = T(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return R.dedup_latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ============================================================== 2F ranks and shares
@register("f1_rank_in_nation", """SELECT c_custkey, c_nationkey, c_acctbal,
       row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank_in_nation
FROM customer""")
def f1_rank_in_nation(spark, sf):
    c = T(spark, sf).customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return R.rank_within(c, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], "rank_in_nation")


@register("f2_share_pct", """SELECT l_returnflag, l_linestatus, n,
       round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY l_returnflag) * 100, 2) AS share_pct
FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def f2_share_pct(spark, sf):
    li = T(spark, sf).lineitem
    agg = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    return R.share_pct(agg, "n", ["l_returnflag"], "share_pct")


@register("f3_global_rank", """SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank
FROM customer""")
def f3_global_rank(spark, sf):
    c = T(spark, sf).customer.select("c_custkey", "c_acctbal")
    return R.global_rank(c, [F.col("c_acctbal").desc(), F.col("c_custkey")], "rank")


# ============================================================== 2G sorts / 2H set ops
@register("g1_global_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def g1_global_sort(spark, sf):
    return T(spark, sf).orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@register("g2_top_n", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate LIMIT 20""")
def g2_top_n(spark, sf):
    li = T(spark, sf).lineitem
    top = R.top_n(li, [F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       "l_quantity", "l_shipdate"], 20)
    return top.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@register("g3_sort_by_number_text", """SELECT s_suppkey, CAST(s_acctbal AS VARCHAR) AS acctbal_text FROM supplier
ORDER BY TRY_CAST(CAST(s_acctbal AS VARCHAR) AS DOUBLE) DESC NULLS LAST, s_suppkey LIMIT 10""")
def g3_sort_by_number_text(spark, sf):
    s = T(spark, sf).supplier.select("s_suppkey", F.col("s_acctbal").cast("string").alias("acctbal_text"))
    return R.sort_by_number(s, "acctbal_text", tie=["s_suppkey"]).limit(10)


@register("g4_preview_limit", """SELECT least(10, count(*)) AS rows, true AS all_from_table FROM events""")
def g4_preview_limit(spark, sf):
    """LIMIT n preview: which rows come back is unspecified, so their number and origin are compared."""
    e = T(spark, sf).events
    known = e.select("event_id", F.lit(True).alias("known")).distinct()
    return e.limit(10).select("event_id").join(known, "event_id", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.bool_and(F.coalesce("known", F.lit(False))), F.lit(True)).alias("all_from_table"))


@register("g5_newest_log_view", r"""SELECT ts, nullif(regexp_extract(props, '"k":\s*(\d+)', 1), '') AS k, event_id
FROM events WHERE event_type IN ('error', 'view') ORDER BY ts DESC, event_id DESC LIMIT 20""")
def g5_newest_log_view(spark, sf):
    e = T(spark, sf).events.where(F.col("event_type").isin("error", "view"))
    v = e.select("ts", *C.parse_fields("props", r'"k":\s*(\d+)', ["k"]), "event_id")
    return R.top_n(v, [F.col("ts").desc(), F.col("event_id").desc()], 20)


# ============================================================== 2M static dims, snapshot split
@register("m4_static_dimension", """SELECT o.o_orderkey, CASE CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
       WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
       WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END AS payment_label FROM orders o""")
def m4_static_dimension(spark, sf):
    o = T(spark, sf).orders
    codes = S.static_dimension(spark, S.PAYMENT_TYPES, "payment_code", "payment_label")
    oo = o.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_code"))
    return oo.join(F.broadcast(codes), "payment_code", "left").select("o_orderkey", "payment_label")


COINS_SQL = f"""coins AS (
  SELECT 'coin-' || CAST(p_partkey AS VARCHAR) AS id, lower(replace(p_brand, '#', '')) AS symbol,
         ' ' || p_name || ' ' AS name, p_retailprice AS current_price, p_retailprice * p_size * 1e7 AS market_cap,
         p_retailprice * 1e6 AS total_volume, p_retailprice * 1.05 AS high_24h, p_retailprice * 0.95 AS low_24h,
         CAST(p_size - 25 AS DOUBLE) AS price_change_percentage_24h, p_size * 1e6 AS circulating_supply,
         p_retailprice * 2 AS ath,
         TIMESTAMP '{ASOF}' - to_days(p_size) - to_hours(p_size % 24) AS ath_ts,
         TIMESTAMP '{ASOF}' AS last_updated_ts
  FROM part)"""


def _coin_tables(spark, sf):
    from tidewater.plans.flows import market
    return market.transform(SI.coins(T(spark, sf)), ASOF, ASOF)


TITLE_SQL = r"""array_to_string(list_transform(regexp_extract_all(trim({x}), '\p{{L}}+|[^\p{{L}}]+'),
         lambda r: upper(r[1]) || lower(r[2:])), '')"""


@register("m5_coin_data", f"""WITH {COINS_SQL}
SELECT id, upper(symbol) AS symbol, {TITLE_SQL.format(x='name')} AS name,
       CASE WHEN market_cap > 100000000000 THEN 'Mega' WHEN market_cap > 10000000000 THEN 'Large'
            WHEN market_cap > 1000000000 THEN 'Mid' ELSE 'Small' END AS market_cap_tier,
       TIMESTAMP '{ASOF}' AS extracted_at FROM coins""")
def m5_coin_data(spark, sf):
    return _coin_tables(spark, sf)["coin_data"]


@register("m5_market_data", f"""WITH {COINS_SQL}
SELECT id, CAST(market_cap AS DECIMAL(38, 2)) AS market_cap, CAST(total_volume AS DECIMAL(38, 2)) AS total_volume,
       CAST(circulating_supply AS DECIMAL(38, 2)) AS circulating_supply,
       CASE WHEN market_cap <> 0 THEN round(total_volume / market_cap, 6) END AS volume_to_mcap_ratio,
       TIMESTAMP '{ASOF}' AS extracted_at FROM coins""")
def m5_market_data(spark, sf):
    return _coin_tables(spark, sf)["market_data"]


@register("m5_price_data", f"""WITH {COINS_SQL}
SELECT id, round(current_price, 4) AS current_price, round(high_24h, 4) AS high_24h, round(low_24h, 4) AS low_24h,
       round(ath, 4) AS ath, ath_ts AS ath_date, round(price_change_percentage_24h, 4) AS price_change_percentage_24h,
       CASE WHEN ath <> 0 THEN round(current_price / ath, 4) END AS price_to_ath_ratio,
       round(high_24h - low_24h, 2) AS daily_price_range,
       CAST(floor((epoch_us(TIMESTAMP '{ASOF}') - epoch_us(ath_ts)) / 86400000000) AS INTEGER) AS days_since_ath,
       last_updated_ts AS last_updated, TIMESTAMP '{ASOF}' AS extracted_at FROM coins""")
def m5_price_data(spark, sf):
    p = _coin_tables(spark, sf)["price_data"]
    return rounded(p)


# ============================================================== 2L quality
ORDERS_SPEC = {"critical": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_comment"],
               "range_column": "o_totalprice", "max_value": 500000.0, "freshness_columns": ["o_orderdate"]}


def _checks_sql(table, critical, present, range_col=None, max_value=None, ts_col=None, min_rows=10,
                max_null=5.0):
    rows = [f"""SELECT 'row_count' AS "check", '{table}' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(count(*) AS DOUBLE) AS value, CAST({float(min_rows)} AS DOUBLE) AS threshold, count(*) >= {min_rows} AS passed,
       printf('%d rows, at least %d wanted', count(*), {min_rows}) AS message FROM {table}"""]
    for c in critical:
        if c in present:
            pct = (f"(CASE WHEN count(*) > 0 THEN count_if({c} IS NULL) * 100.0 / count(*) ELSE 0.0 END)")
            rows.append(f"""SELECT 'null_pct', '{table}', '{c}', CAST(round({pct}, 2) AS DOUBLE), CAST({max_null} AS DOUBLE),
       {pct} <= {max_null},
       printf('{c} is null in %.2f%% of rows, at most %.1f%% allowed', {pct}, {max_null}) FROM {table}""")
        else:
            rows.append(f"""SELECT 'null_pct', '{table}', '{c}', NULL, CAST({max_null} AS DOUBLE), false,
       'no column {c}'""")
    missing = sorted(c for c in critical if c not in present)
    msg = f"absent: {', '.join(missing)}" if missing else "every critical column is there"
    rows.append(f"SELECT 'schema', '{table}', NULL, CAST({float(len(missing))} AS DOUBLE), CAST(0.0 AS DOUBLE), "
                f"{str(not missing).lower()}, '{msg}'")
    if range_col:
        neg, ext = f"count_if({range_col} < 0)", f"count_if({range_col} > {max_value})"
        rows.append(f"""SELECT 'value_range', '{table}', '{range_col}', CAST({neg} + {ext} AS DOUBLE),
       CAST({max_value} AS DOUBLE),
       {neg} + {ext} = 0, printf('{range_col} below 0 in %d rows, above %d in %d', {neg}, {int(max_value)}, {ext})
       FROM {table}""")
    if ts_col:
        latest = f"max({ts_col})"
        cutoff = f"(TIMESTAMP '{ASOF}' - INTERVAL 48 HOUR)"
        rows.append(f"""SELECT 'freshness', '{table}', '{ts_col}',
       CAST(floor((epoch_us({cutoff}) - epoch_us({latest})) / 3600000000) AS DOUBLE), CAST(48.0 AS DOUBLE),
       coalesce({latest} >= {cutoff}, true),
       'newest ' || CAST({latest} AS VARCHAR) || ', due ' || CAST({cutoff} AS VARCHAR) FROM {table}""")
    else:
        rows.append(f"""SELECT 'freshness', '{table}', NULL, NULL, CAST(48.0 AS DOUBLE), true,
       'no time column to judge by'""")
    return "\nUNION ALL ".join(rows)


ORDERS_CHECKS_SQL = _checks_sql("orders", ORDERS_SPEC["critical"],
                                ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                                "o_totalprice", 500000.0, "o_orderdate")
CUSTOMER_CHECKS_SQL = _checks_sql("customer", ["c_custkey", "c_name", "c_acctbal"],
                                  ["c_custkey", "c_name", "c_acctbal"], "c_acctbal", 50000000000.0, None)
EVENTS_CHECKS_SQL = _checks_sql("events", ["event_id", "ts", "user_id"], ["event_id", "ts", "user_id"],
                                None, None, "ts")


@register("l1_l5_orders_checks", ORDERS_CHECKS_SQL)
def l1_l5_orders_checks(spark, sf):
    return Q.table_checks(T(spark, sf).orders, "orders", asof=ASOF, **ORDERS_SPEC)


@register("l4_customer_value_range", CUSTOMER_CHECKS_SQL)
def l4_customer_value_range(spark, sf):
    return Q.table_checks(T(spark, sf).customer, "customer", ["c_custkey", "c_name", "c_acctbal"],
                          range_column="c_acctbal", asof=ASOF)


@register("l5_events_freshness", EVENTS_CHECKS_SQL)
def l5_events_freshness(spark, sf):
    return Q.table_checks(T(spark, sf).events, "events", ["event_id", "ts", "user_id"],
                          freshness_columns=["ts"], asof=ASOF)


@register("l6_l7_gate", f"""WITH c AS ({ORDERS_CHECKS_SQL} UNION ALL {EVENTS_CHECKS_SQL}
  UNION ALL SELECT 'read_table', 'missing_table', NULL, NULL, NULL, false, 'unreadable')
SELECT bool_and(passed) AS quality_passed, CAST(count_if(passed) AS INTEGER) AS checks_passed,
       CAST(count(*) AS INTEGER) AS checks_total FROM c""")
def l6_l7_gate(spark, sf):
    t = T(spark, sf)
    _, summary = Q.gate(spark, {"orders": t.orders, "events": t.events,
                                "missing_table": f"{sf}/no_such_table.parquet"},
                        {"orders": ORDERS_SPEC,
                         "events": {"critical": ["event_id", "ts", "user_id"], "freshness_columns": ["ts"]}},
                        asof=ASOF)
    return summary


@register("l7_read_failure", f"""SELECT "check", table_name, passed FROM ({ORDERS_CHECKS_SQL})
UNION ALL SELECT 'read_table', 'absent', false UNION ALL SELECT 'read_table', 'torn', false""")
def l7_read_failure(spark, sf):
    """One table is absent, one cannot be read when its files are opened; the third is checked as usual."""
    t = T(spark, sf)
    torn = scratch_dir(spark, "l7-torn")
    t.nation.write.parquet(f"{torn}/good")
    # text under a Parquet name: the schema comes from the good file, the fault shows on reading
    t.nation.select("n_name").coalesce(1).write.text(f"{torn}/text")
    files = spark.read.schema(t.nation.schema).option("recursiveFileLookup", "true").parquet(f"{torn}/good", f"{torn}/text")
    checks, _ = Q.gate(spark, {"orders": t.orders, "absent": f"{sf}/no_such_table.parquet", "torn": files},
                       {"orders": ORDERS_SPEC, "torn": {"critical": ["n_name"]}}, asof=ASOF)
    return checks.select("check", "table_name", "passed")


@register("l8_sample_bound", """SELECT 'row_count' AS "check", 'orders' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(count(*) AS DOUBLE) AS value, CAST(10.0 AS DOUBLE) AS threshold, count(*) >= 10 AS passed,
       printf('%d rows, at least %d wanted', count(*), 10) AS message FROM orders""")
def l8_sample_bound(spark, sf):
    """Checks see the whole table: the row count they report is the table's."""
    checks = Q.table_checks(T(spark, sf).orders, "orders", [], asof=ASOF)
    return checks.where(F.col("check") == "row_count")


@register("l9_l13_tests", """SELECT 'not_null_orders_o_orderkey' AS test_name, count(*) AS failures,
       CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'unique_orders_o_orderkey', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique_lineitem_order_line', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'accepted_values_orders_status', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'relationships_orders_customer', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'assert_empty_negative_price', count(*), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM orders WHERE o_totalprice < 0""")
def l9_l13_tests(spark, sf):
    t = T(spark, sf)
    o, li = t.orders, t.lineitem
    return Q.test_results({
        "not_null_orders_o_orderkey": Q.not_null(o, "o_orderkey"),
        "unique_orders_o_orderkey": Q.unique(o, ["o_orderkey"]),
        "unique_lineitem_order_line": Q.unique(li, ["l_orderkey", "l_linenumber"]),
        "accepted_values_orders_status": Q.accepted_values(o, "o_orderstatus", ["F", "O"]),
        "relationships_orders_customer": Q.relationships(o, t.customer, "o_custkey", "c_custkey"),
        "assert_empty_negative_price": o.where(F.col("o_totalprice") < 0),
    })
