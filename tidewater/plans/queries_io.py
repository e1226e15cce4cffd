"""Registered source / sink / catalog queries.

Each query writes the driver table in the layout the operator reads (a fresh
folder under the shared checkpoint location), runs the operator and returns
what it read back, so the oracle is the source table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.sources import catalog as CAT
from tidewater.sources import readers as RD
from tidewater.sources import writers as W
from tidewater.plans import standins as SI
from tidewater.plans.registry import register, rounded
from tidewater.session import scratch_dir

ASOF = SI.ASOF


def T(spark, sf):
    return SI.Tables(spark, sf)


# ============================================================== 2A sources
@register("a1_read_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def a1_read_csv(spark, sf):
    out = W.write_csv(T(spark, sf).nation, scratch_dir(spark, "a1"))
    return RD.read_csv(spark, out).select("n_nationkey", "n_name", "n_regionkey")


CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@register("a2_read_csv_by_name", """SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def a2_read_csv_by_name(spark, sf):
    c = T(spark, sf).customer
    out = scratch_dir(spark, "a2")
    seg = F.col("c_mktsegment")
    # three header layouts in one folder: reordered behind a name that holds a comma, upper-cased, and one column missing
    (c.where(seg.isin("BUILDING", "MACHINERY")).select(F.lit("1,2").alias("c_name,c_custkey"), "c_mktsegment", "c_acctbal", "c_custkey", "c_name",
                                                         "c_nationkey")
     .write.mode("append").option("header", True).csv(out))
    (c.where(seg.isin("AUTOMOBILE", "HOUSEHOLD"))
     .select(*[F.col(x).alias(x.upper()) for x in ["c_name", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal"]])
     .write.mode("append").option("header", True).csv(out))
    (c.where(seg == "FURNITURE").select("c_nationkey", "c_custkey", "c_mktsegment", "c_name")
     .write.mode("append").option("header", True).csv(out))
    return RD.read_csv_by_name(spark, out, CUSTOMER_SCHEMA)


@register("a2_read_csv_multi_line", """SELECT c_custkey, c_name || chr(10) || '"of", ' || c_mktsegment AS c_name, c_nationkey, c_acctbal,
       c_mktsegment, true AS line_reader_refuses FROM customer""")
def a2_read_csv_multi_line(spark, sf):
    """Quoted cells with line breaks, commas and quotes, in the header too; read line by line they are refused."""
    c = T(spark, sf).customer
    out = scratch_dir(spark, "a2m")
    c = c.withColumn("c_name", F.concat("c_name", F.lit('\n"of", '), "c_mktsegment"))
    odd = c.where(F.col("c_custkey") % 2 == 1).select(F.lit("n").alias("free\ntext, quoted"), "c_name", "c_acctbal", "c_custkey", "c_mktsegment", "c_nationkey")
    for part in (odd, c.where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal", "c_name")):
        part.write.mode("append").option("header", True).option("escape", '"').csv(out)
    try:
        RD.read_csv_by_name(spark, out, CUSTOMER_SCHEMA)
        refused = False
    except ValueError:
        refused = True
    return RD.read_csv_by_name(spark, out, CUSTOMER_SCHEMA, multi_line=True).withColumn("line_reader_refuses", F.lit(refused))


SUPPLIER_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


@register("a3_read_csv_external", """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ', "ltd"' AS s_name,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier""")
def a3_read_csv_external(spark, sf):
    s = T(spark, sf).supplier.withColumn("s_name", F.concat("s_name", F.lit(', "ltd"')))
    out = scratch_dir(spark, "a3")
    s.write.option("header", True).option("escape", "\\").csv(out)
    return RD.read_csv_external(spark, out, SUPPLIER_COLS)


@register("a4_read_csv_prefix", """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
       CAST(n_regionkey AS VARCHAR) AS n_regionkey, '' AS n_comment, n_name || ', "the"' AS "long,name",
       CASE WHEN n_regionkey < 2 THEN 'part_a' ELSE 'part_b' END AS folder FROM nation""")
def a4_read_csv_prefix(spark, sf):
    """Two folders whose headers differ in order and case: each file is read by its own."""
    n = T(spark, sf).nation.withColumn("long,name", F.concat("n_name", F.lit(', "the"')))
    out = scratch_dir(spark, "a4")
    n.where(F.col("n_regionkey") < 2).write.option("header", True).option("escape", '"').csv(f"{out}/part_a")
    n.where(F.col("n_regionkey") >= 2).select(F.col("long,name").alias("LONG,name"), F.col("n_regionkey").alias("N_REGIONKEY"), "n_name", F.col("n_nationkey").alias("N_NationKey")) \
        .write.option("header", True).option("escape", '"').csv(f"{out}/part_b")
    df = RD.read_csv_prefix(spark, out, ["n_nationkey", "n_name", "n_regionkey", "n_comment", "long,name"])
    return df.withColumn("folder", F.regexp_extract("_source_file", "/(part_[ab])/", 1)).drop("_source_file")


EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@register("a5_read_json_lines", "SELECT * FROM events")
def a5_read_json_lines(spark, sf):
    out = scratch_dir(spark, "a5")
    W.write_json(T(spark, sf).events, out)
    return RD.read_json_lines(spark, out, EVENTS_SCHEMA)


@register("a6_read_json_array", "SELECT item_id, text FROM benchmark")
def a6_read_json_array(spark, sf):
    b = T(spark, sf).benchmark
    out = scratch_dir(spark, "a6")
    # one JSON array document per file: pages of at most 20 items, all in one folder
    pages = (b.groupBy(F.floor(F.col("item_id") / 20).alias("page"))
             .agg(F.to_json(F.collect_list(F.struct("item_id", "text"))).alias("doc")))
    pages.select("doc").write.option("maxRecordsPerFile", 1).text(out)
    return RD.read_json_array(spark, out, "item_id long, text string").select("item_id", "text")


@register("a7_read_json_concat", """SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS VARCHAR) AS bad FROM events
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{"broken" ' || CAST(event_id AS VARCHAR) FROM events WHERE event_id % 500 = 0""")
def a7_read_json_concat(spark, sf):
    """Glued objects with broken ones among them: the good ones are typed, a broken one keeps its text."""
    e = T(spark, sf).events
    out = scratch_dir(spark, "a7")
    # objects glued with no separator ("}{"), at most 200 per text (one delivery
    # batch), several texts per file; some texts end in a broken object
    glued = (e.groupBy(F.date_trunc("hour", "ts").alias("h"), F.floor(F.col("event_id") / 200).alias("b"))
             .agg(F.concat_ws("", F.collect_list(W.json_text(*e.columns)), F.collect_list(F.when(
                 F.col("event_id") % 500 == 0, F.concat(F.lit('{"broken" '), F.col("event_id").cast("string"))))).alias("value")))
    glued.select("value").write.option("maxRecordsPerFile", 200).text(out)
    return RD.read_json_concat(spark, out, EVENTS_SCHEMA, skip_bad=False, corrupt="bad").withColumn("bad", F.rtrim("bad")).drop("_source_file")


@register("a8_read_arrival_tree", """SELECT *, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events""")
def a8_read_arrival_tree(spark, sf):
    e = T(spark, sf).events
    out = scratch_dir(spark, "a8")
    from tidewater.streaming.streams import archive_layout
    archive_layout(e, "ts").write.partitionBy("year", "month", "day", "hour").options(**W.JSON_OPTIONS).json(out)
    return RD.read_arrival_tree(spark, out, EVENTS_SCHEMA)


@register("a9_read_partitioned", """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 4) AS revenue
FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY l_returnflag""")
def a9_read_partitioned(spark, sf):
    out = W.write_parquet(T(spark, sf).lineitem, scratch_dir(spark, "a9"), partition_by=["l_returnflag"])
    df = RD.read_partitioned(spark, out, F.col("l_returnflag").isin("A", "R"))
    return rounded(df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sum("l_extendedprice").alias("revenue")))


MIXED_MAPPING = [("c_custkey", "long", "customer_id", "long"), ("c_name", "string", "name", "string"),
                 ("c_acctbal", "double", "balance", "double"), ("c_mktsegment", "string", "segment", "string")]


@register("a10_read_mixed", """SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer""")
def a10_read_mixed(spark, sf):
    """CSV files with two header orders, and JSON rows, under one prefix."""
    c = T(spark, sf).customer
    out = scratch_dir(spark, "a10")
    c.where(F.col("c_acctbal") >= 7000).write.option("header", True).csv(f"{out}/csv/a")
    c.where((F.col("c_acctbal") >= 4500) & (F.col("c_acctbal") < 7000)).select("c_mktsegment", "c_acctbal", "c_name", "c_custkey") \
        .write.option("header", True).csv(f"{out}/csv/b")
    c.where(F.col("c_acctbal") < 4500).write.json(f"{out}/api")
    return RD.read_mixed(spark, out, MIXED_MAPPING)


def _nested_conversations(conv):
    """Envelope documents ``{kind, etag, conv_id, items: [{id, snippet: {title, role}}]}``,
    at most 50 items each, plus one document per conversation with no items."""
    page = F.floor(F.col("turn") / 50)
    docs = (conv.groupBy("conv_id", page.alias("page"))
            .agg(F.collect_list(F.struct(F.col("turn").alias("id"),
                                         F.struct(F.col("text").alias("title"), F.col("role")).alias("snippet")))
                 .alias("items"))
            .select(F.lit("listResponse").alias("kind"), F.concat(F.lit("etag-"), F.col("conv_id")).alias("etag"),
                    "conv_id", "items"))
    empty = (conv.select("conv_id").distinct()
             .select(F.lit("listResponse").alias("kind"), F.lit("etag-empty").alias("etag"), "conv_id",
                     F.array().cast("array<struct<id:bigint,snippet:struct<title:string,role:string>>>")
                     .alias("items")))
    return docs.unionByName(empty)


@register("a11_explode_items", """SELECT conv_id, turn AS id, text AS snippet_title, role AS snippet_role
FROM conversations""")
def a11_explode_items(spark, sf):
    out = scratch_dir(spark, "a11")
    _nested_conversations(T(spark, sf).conversations).write.json(out)
    docs = spark.read.json(out)
    return RD.explode_items(docs, "items", keep=["conv_id"])


@register("a12_envelope", """SELECT role AS region, CAST(sum(n) AS BIGINT) AS items, CAST(sum((n + 49) // 50) AS BIGINT) AS documents,
       CAST(max(least(n, 50)) AS INTEGER) AS largest FROM (SELECT role, source, count(*) AS n FROM
       (SELECT role, conv_id % 3 AS source FROM conversations) GROUP BY 1, 2) GROUP BY role""")
def a12_envelope(spark, sf):
    conv = T(spark, sf).conversations
    out = scratch_dir(spark, "a12")
    rows = conv.select("role", (F.col("conv_id") % 3).alias("source"), F.concat_ws("/", F.lpad(F.col("conv_id").cast("string"), 12, "0"),
                       F.lpad(F.col("turn").cast("string"), 6, "0")).alias("id"), "text")
    env = RD.with_envelope(rows, ["role", "source"], f"ing-{uuid.uuid4().hex[:8]}", "role", "api", ASOF, order="id")
    env.drop("role", "source").write.partitionBy("region", "date", "hour").json(out)
    back = spark.read.json(out)
    n = F.col("_pipeline_metadata.video_count")
    return back.groupBy("region").agg(F.sum(n).alias("items"), F.count(F.lit(1)).alias("documents"), F.max(n).cast("int").alias("largest"))


@register("a13_read_table", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def a13_read_table(spark, sf):
    o = RD.read_table(spark, "taxi_source.orders", {"taxi_source.orders": T(spark, sf).path("orders")})
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("a20_list_files", "SELECT r_name AS name, true AS has_rows FROM region")
def a20_list_files(spark, sf):
    """Listing of files under their names: one file is written for each region, in a folder of its name."""
    out = scratch_dir(spark, "a20")
    T(spark, sf).region.repartition("r_name").write.partitionBy("r_name").parquet(out)
    files = RD.list_files(spark, out, suffix=".parquet")
    return files.select(F.url_decode(F.regexp_extract("path", "r_name=([^/]+)/", 1)).alias("name"), (F.col("length") > 0).alias("has_rows"))


# ============================================================== 2B sinks
@register("b1_write_parquet", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def b1_write_parquet(spark, sf):
    """Whole-table overwrite by a subset of the partitions: the others are gone."""
    o = T(spark, sf).orders
    out = scratch_dir(spark, "b1")
    W.write_parquet(o, out, partition_by=["o_orderstatus"])
    W.write_parquet(o.where(F.col("o_orderstatus") == "F"), out, partition_by=["o_orderstatus"])
    return spark.read.parquet(out).select(*o.columns)


@register("b2_write_idempotent", """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 4) AS revenue
FROM lineitem GROUP BY l_returnflag""")
def b2_write_idempotent(spark, sf):
    li = T(spark, sf).lineitem
    out = scratch_dir(spark, "b2")
    W.write_idempotent(li, out, ["l_returnflag"])
    W.write_idempotent(li.where(F.col("l_returnflag") == "R"), out, ["l_returnflag"])  # rerun one partition
    W.write_idempotent(li, out, ["l_returnflag"])                                       # rerun all
    back = spark.read.parquet(out)
    return rounded(back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                                    F.sum("l_extendedprice").alias("revenue")))


@register("b3_write_dataset", """SELECT p_size, count(*) * CASE WHEN p_size <= 5 THEN 2 ELSE 1 END AS n FROM part WHERE p_size <= 20 GROUP BY p_size""")
def b3_write_dataset(spark, sf):
    """Append, overwrite by a subset (the rest goes), replace single partitions (the rest stays)."""
    p = T(spark, sf).part
    out = scratch_dir(spark, "b3")
    name = f"b3_part_{uuid.uuid4().hex[:8]}"
    W.write_dataset(p, out, "append", partition_by=["p_size"])
    W.write_dataset(p.where(F.col("p_size") <= 20), out, "overwrite", partition_by=["p_size"], table=name)
    W.write_dataset(p.where(F.col("p_size") <= 10), out, "append", partition_by=["p_size"])
    W.write_dataset(p.where(F.col("p_size").between(6, 10)), out, "overwrite_partitions", partition_by=["p_size"])
    return spark.table(name).groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))


@register("b4_one_file_per_partition", "SELECT l_returnflag, CAST(1 AS BIGINT) AS n_files FROM lineitem GROUP BY 1")
def b4_one_file_per_partition(spark, sf):
    out = scratch_dir(spark, "b4")
    W.write_one_file_per_partition(T(spark, sf).lineitem, out, ["l_returnflag"])
    files = RD.list_files(spark, out, suffix=".parquet")
    return (files.select(F.regexp_extract("path", r"l_returnflag=([^/]+)/", 1).alias("l_returnflag"))
            .groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_files")))


@register("b5_write_csv", """SELECT row_number() OVER (ORDER BY n_nationkey) AS row_index, n_nationkey, n_name,
       n_regionkey FROM nation""")
def b5_write_csv(spark, sf):
    out = scratch_dir(spark, "b5")
    W.write_csv(T(spark, sf).nation, out, index_col="row_index", order=["n_nationkey"])
    return spark.read.schema("row_index long, n_nationkey int, n_name string, n_regionkey int") \
        .option("header", True).csv(out)


@register("b9_to_messages", "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages FROM events GROUP BY 1")
def b9_to_messages(spark, sf):
    msgs = W.to_messages(T(spark, sf).events, "user_id", order=["ts"])
    return msgs.groupBy("key").agg(F.count(F.lit(1)).alias("messages"))


@register("b9_messages_ordered", """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages, CAST(0 AS BIGINT) AS out_of_order
FROM events GROUP BY 1""")
def b9_messages_ordered(spark, sf):
    """Key-ordered delivery: within each key, messages leave in time order.

    Checked with two skew-safe ranks per key (by delivery position, by time); a
    message is out of order when they differ."""
    from tidewater.operators.relational import rank_within
    e = T(spark, sf).events
    # written as they leave: position is the place in the file of the key's partition
    sent = scratch_dir(spark, "b9-sent")
    W.to_messages(e, "user_id", order=["ts"]).withColumn("pos", F.monotonically_increasing_id()).write.parquet(sent)
    parsed = spark.read.parquet(sent).select("key", "pos", F.get_json_object("value", "$.ts").alias("ts"))
    by_pos = rank_within(parsed, ["key"], [F.col("pos")], "r_pos")
    both = rank_within(by_pos, ["key"], [F.col("ts"), F.col("pos")], "r_ts")
    return both.groupBy("key").agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("r_pos") != F.col("r_ts")).alias("out_of_order"))


@register("b10_register_table", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def b10_register_table(spark, sf):
    out = W.write_parquet(T(spark, sf).lineitem, scratch_dir(spark, "b10"), partition_by=["l_returnflag"])
    name = CAT.register_table(spark, out, "tidewater_silver", f"lineitem_{uuid.uuid4().hex[:8]}")
    return spark.sql(f"SELECT l_returnflag, l_linestatus, count(*) AS n FROM {name} GROUP BY 1, 2")


@register("b11_catalog_path", """SELECT * FROM (VALUES ('mixed', 'json,parquet', 'rejected: mixed formats', CAST(NULL AS BIGINT)),
  ('nation', 'csv', 'registered', (SELECT count(*) FROM nation)), ('orders', 'parquet', 'registered', (SELECT count(*) FROM orders)),
  ('region', 'json', 'registered', (SELECT count(*) FROM region))) AS v(table_name, format, status, rows)""")
def b11_catalog_path(spark, sf):
    """Crawl a root of folders into tables (parquet, csv, json, one mixed folder), and count each table's rows."""
    t = T(spark, sf)
    root, db = scratch_dir(spark, "b11"), f"crawl_{uuid.uuid4().hex[:8]}"
    t.orders.write.parquet(f"{root}/orders")
    t.nation.write.option("header", True).csv(f"{root}/nation")
    t.region.write.json(f"{root}/region")
    t.region.write.json(f"{root}/mixed")
    t.region.write.mode("append").parquet(f"{root}/mixed")
    found = CAT.catalog_path(spark, root, db)
    counts = None
    for name in ("nation", "orders", "region"):
        n = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = n if counts is None else counts.unionByName(n)
    return found.join(counts, "table_name", "left").select("table_name", "format", "status", "rows")


@register("b11_crawl_again", """SELECT * FROM (VALUES ('customer', 'updated', '+ c_acctbal double', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer WHERE c_custkey % 2 = 1)),
  ('nation', 'unchanged', NULL, (SELECT count(*) FROM nation), NULL), ('region', 'rejected: files of different headers', NULL, NULL, NULL),
  ('supplier', 'registered', NULL, (SELECT count(*) FROM supplier), NULL)) AS v(table_name, status, changes, rows, balances)""")
def b11_crawl_again(spark, sf):
    """A second crawl: one folder has got files with a column more, one a partition more, one files of another
    header, one is new; the tables' rows are counted through the catalog."""
    t = T(spark, sf)
    root, db = scratch_dir(spark, "b11a"), f"crawl_{uuid.uuid4().hex[:8]}"
    odd = F.col("c_custkey") % 2 == 1
    t.customer.where(~odd).select("c_custkey", "c_name").write.parquet(f"{root}/customer")
    t.nation.where(F.col("n_regionkey") < 3).write.partitionBy("n_regionkey").parquet(f"{root}/nation")
    t.region.write.option("header", True).csv(f"{root}/region")
    CAT.catalog_path(spark, root, db)
    t.customer.where(odd).select("c_custkey", "c_name", "c_acctbal").write.mode("append").parquet(f"{root}/customer")
    t.nation.where(F.col("n_regionkey") >= 3).write.mode("append").partitionBy("n_regionkey").parquet(f"{root}/nation")
    t.region.select("r_name", "r_regionkey").write.mode("append").option("header", True).csv(f"{root}/region")
    t.supplier.write.json(f"{root}/supplier")
    found = CAT.catalog_path(spark, root, db).select("table_name", "status", "changes")
    counts = None
    for name in ("customer", "nation", "supplier"):
        n = spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows"), (F.count("c_acctbal") if name == "customer" else F.lit(None).cast("long")).alias("balances"))
        n = n.select(F.lit(name).alias("table_name"), "rows", "balances")
        counts = n if counts is None else counts.unionByName(n)
    return found.join(counts, "table_name", "left").select("table_name", "status", "changes", "rows", "balances")


@register("b12_create_external", "SELECT * FROM region")
def b12_create_external(spark, sf):
    out = scratch_dir(spark, "b12")
    T(spark, sf).region.write.option("header", True).csv(out)
    name = f"region_ext_{uuid.uuid4().hex[:8]}"
    CAT.create_external(spark, name, "r_regionkey int, r_name string", out, "csv", {"header": "true"})
    return spark.table(name)


@register("b13_landing_like", "SELECT count(*) AS n FROM orders")
def b13_landing_like(spark, sf):
    """Typed landing table, a second one ``LIKE`` it, and an append into it."""
    base = scratch_dir(spark, "b13")
    a, b = f"landing_{uuid.uuid4().hex[:8]}", f"landing_like_{uuid.uuid4().hex[:8]}"
    CAT.create_landing(spark, a, "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz", f"{base}/a")
    CAT.create_landing(spark, b, "", f"{base}/b", like=a)
    T(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderdate").write.insertInto(b)
    return spark.table(b).groupBy().agg(F.count(F.lit(1)).alias("n"))


@register("b15_materialize", """WITH by_status AS (SELECT o_orderstatus, round(sum(o_totalprice), 4) AS revenue,
       count(*) AS orders FROM orders GROUP BY 1)
SELECT o_orderstatus, revenue, orders, round(revenue / orders, 4) AS avg_order FROM by_status""")
def b15_materialize(spark, sf):
    """The model that refers to the other one is declared first."""
    m = CAT.Models(spark, {"taxi_source.facts": T(spark, sf).orders})
    m.declare("avg_order", lambda r: r.ref("by_status").withColumn("avg_order", F.col("revenue") / F.col("orders")))
    m.declare("by_status", lambda r: r.ref("taxi_source.facts").groupBy("o_orderstatus").agg(
        F.sum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("orders")), as_="table",
        path=f"{scratch_dir(spark, 'b15')}/by_status")
    return rounded(m.run()["avg_order"])


@register("b17_write_json", "SELECT * FROM nation")
def b17_write_json(spark, sf):
    out = W.write_json(T(spark, sf).nation, scratch_dir(spark, "b17"))
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(out)


@register("b18_delivery_report", """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count_if(event_type = 'error') AS bad FROM events GROUP BY 1)
SELECT count(*) + 1 AS files, CAST(sum(CASE WHEN day(day) = 13 THEN n ELSE n + bad END) AS BIGINT) AS records,
       CAST(sum(CASE WHEN day(day) = 13 THEN 0 ELSE n END) AS BIGINT) AS sent, CAST(sum(CASE WHEN day(day) = 13 THEN n ELSE bad END) AS BIGINT) AS skipped,
       CAST(1 + count_if(day(day) = 13) AS BIGINT) AS failed, true AS raised FROM d""")
def b18_delivery_report(spark, sf):
    """Daily folders of record lines: one day holds no readable record and one gzip file is torn;
    both fail, the others are sent, and the run raises after every file was tried."""
    e = T(spark, sf).events
    out = scratch_dir(spark, "b18")
    good = W.json_text(*e.columns)
    # each error event is followed by a malformed line in the same daily folder
    lines = e.select(F.to_date("ts").alias("day"), F.explode(F.when(F.dayofmonth("ts") == 13, F.array(F.lit("{broken"))).when(
        F.col("event_type") == "error", F.array(good, F.lit("{not json"))).otherwise(F.array(good))).alias("value"))
    lines.write.partitionBy("day").text(out)
    _tear(spark, e.select(good.alias("value")), out)
    lines, unreadable = W.read_delivery(spark, out)
    day = F.regexp_extract("file_path", "day=([^/]+)/", 1)
    summary = W.report_summary(W.delivery_report(lines.withColumn("file_path", day), unreadable))
    try:
        W.raise_on_failures(summary)
        raised = False
    except RuntimeError:
        raised = True
    return summary.withColumn("raised", F.lit(raised))


def _tear(spark, lines, folder):
    """Add the first half of a gzip file of ``lines`` to a folder, as a delivery that broke off leaves it."""
    whole = scratch_dir(spark, "b18-whole")
    lines.where(F.hash("value") % 50 == 0).coalesce(1).write.option("compression", "gzip").text(whole)
    content = bytes(spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(whole).first()["content"])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/torn.txt.gz")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(content[:len(content) // 2]))
    out.close()
