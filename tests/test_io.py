"""Readers, writers and the catalog: round trips and the edge rows of FIXTURES.md."""

import pytest
from pyspark.sql import functions as F

from tidewater.sources import catalog as CAT
from tidewater.sources import readers as RD
from tidewater.sources import writers as W


def test_read_csv_by_name_matches_shuffled_headers(spark, tmp):
    out = tmp("csvname")
    spark.createDataFrame([("1", "Ann", "3.5")], "id string, name string, amount string") \
        .write.option("header", True).csv(f"{out}/a")
    spark.createDataFrame([("7.25", "2", "Bo, Jr")], "AMOUNT string, ID string, Name string") \
        .write.option("header", True).csv(f"{out}/b")
    spark.createDataFrame([("3",)], "Id string").write.option("header", True).csv(f"{out}/c")
    got = sorted(tuple(r) for r in RD.read_csv_by_name(spark, out, "id long, name string, amount double").collect())
    assert got == [(1, "Ann", 3.5), (2, "Bo, Jr", 7.25), (3, None, None)]


def test_read_json_concat_splits_objects_and_keeps_braces_in_strings(spark, tmp):
    out = tmp("glued")
    text = '{"a": 1, "s": "x}{y"}{"a": 2, "s": "z"}{broken{"a": 3, "s": ""}'
    spark.createDataFrame([(text,)], "value string").write.text(out)
    got = sorted((r.a, r.s) for r in RD.read_json_concat(spark, out, "a int, s string").collect()
                 if r.a is not None)
    assert got == [(1, "x}{y"), (2, "z"), (3, "")]


def test_explode_items_skips_empty_items(spark, tmp):
    out = tmp("items")
    docs = ['{"kind": "k", "items": [{"id": "1", "snippet": {"title": "A"}}, {"id": "2", "snippet": {"title": "B"}}]}',
            '{"kind": "k", "items": []}']
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(out)
    got = RD.explode_items(spark.read.json(out), "items", keep=["kind"])
    assert got.columns == ["kind", "id", "snippet_title"]
    assert sorted(r.snippet_title for r in got.collect()) == ["A", "B"]


def test_arrival_tree_folders_become_columns(spark, tmp):
    out = tmp("tree")
    spark.createDataFrame([(1,)], "x int").write.json(f"{out}/2024/01/02/03")
    r = RD.read_arrival_tree(spark, out, "x int").first()
    assert (r.year, r.month, r.day, r.hour) == ("2024", "01", "02", "03")


def test_partition_predicate_prunes_folders(spark, tmp):
    out = W.write_parquet(spark.range(100).withColumn("p", F.col("id") % 4), tmp("parts"), partition_by=["p"])
    df = RD.read_partitioned(spark, out, F.col("p") == 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and df.count() == 25


def test_idempotent_write_twice_equals_once(spark, tmp):
    out = tmp("idem")
    df = spark.range(50).withColumn("p", F.col("id") % 5)
    W.write_idempotent(df, out, ["p"])
    W.write_idempotent(df.where("p = 1"), out, ["p"])
    W.write_idempotent(df, out, ["p"])
    assert spark.read.parquet(out).count() == 50


def test_one_file_per_partition(spark, tmp):
    out = W.write_one_file_per_partition(spark.range(1000).withColumn("p", F.col("id") % 3), tmp("onefile"), ["p"])
    files = RD.list_files(spark, out, suffix=".parquet").collect()
    assert len(files) == 3


def test_delivery_report_counts_bad_lines(spark, tmp):
    out = tmp("report")
    spark.createDataFrame([('{"a":1}',), ("{oops",), ('{"a":2}',)], "value string").coalesce(1).write.text(out)
    lines = spark.read.text(out).select("value", F.col("_metadata.file_path").alias("file_path"))
    s = W.report_summary(W.delivery_report(lines)).first()
    assert (s.files, s.records, s.sent, s.skipped, s.failed) == (1, 3, 2, 1, 0)


def test_register_table_and_catalog_path(spark, tmp):
    root = tmp("crawl")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{root}/t1")
    spark.range(3).write.json(f"{root}/t2")
    spark.range(3).write.json(f"{root}/mixed")
    spark.range(3).write.mode("append").parquet(f"{root}/mixed")
    res = {r.table_name: r.status for r in CAT.catalog_path(spark, root, "crawl_test").collect()}
    assert res["t1"] == "registered" and res["t2"] == "registered" and res["mixed"].startswith("rejected")
    assert spark.table("crawl_test.t1").count() == 10


def test_to_messages_keeps_key_order(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 2), (1, 2)], "k int, t int")
    msgs = W.to_messages(df, "k", partitions=2, order=["t"]).collect()
    ts = [int(m.value.split('"t":')[1].rstrip("}")) for m in msgs if m.key == "1"]
    assert ts == sorted(ts)


def test_a_load_that_broke_off_is_loaded_again_once(spark, tmp):
    from tidewater.sources import loads as LD
    src, target, log = tmp("ci-src"), tmp("ci-target"), tmp("ci-log")
    schema, asof = "id long, v string", "2024-02-01 00:00:00"
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.option("header", True).csv(f"{src}/d1")
    n = LD.copy_into(spark, src, target, schema, log, asof)
    assert n > 0
    # the last mark never got written: the same history without it
    broken = tmp("ci-broken")
    spark.read.parquet(log).where("status = 'LOADING'").write.parquet(broken)
    spark.createDataFrame([(3, "c")], schema).write.option("header", True).csv(f"{src}/d2")       # and a file came meanwhile
    assert LD.copy_into(spark, src, target, schema, broken, asof) > n
    assert sorted(r.id for r in LD.read_landing(spark, target).collect()) == [1, 2, 3]
    assert LD.copy_into(spark, src, target, schema, broken, asof) == 0
    with pytest.raises(ValueError):     # a history that does not know the loads is refused
        LD.copy_into(spark, src, target, schema, tmp("ci-other"), asof)


def test_copy_into_in_another_time_zone(spark, tmp):
    from tidewater.sources import loads as LD
    zone = spark.conf.get("spark.sql.session.timeZone")
    src, target, log = tmp("tz-src"), tmp("tz-target"), tmp("tz-log")
    try:
        for i, z in enumerate(("Pacific/Auckland", "America/Los_Angeles", "UTC")):
            spark.conf.set("spark.sql.session.timeZone", z)
            spark.createDataFrame([(i,)], "id long").coalesce(1).write.option("header", True).csv(f"{src}/d{i}")
            assert LD.copy_into(spark, src, target, "id long", log, "2024-02-01 00:00:00") == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(r.id for r in LD.read_landing(spark, target).collect()) == [0, 1, 2]


def test_header_order_differs_between_files(spark, tmp):
    out = tmp("orders")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).csv(f"{out}/x")
    spark.createDataFrame([("20", "10")], "b string, a string").write.option("header", True).csv(f"{out}/y")
    assert sorted((r.a, r.b) for r in RD.read_csv_prefix(spark, out, ["a", "b"]).collect()) == [("1", "2"), ("10", "20")]


def test_bad_objects_keep_their_text(spark, tmp):
    out = tmp("glued-bad")
    spark.createDataFrame([('{"a": 1}{broken{"a": 3}',)], "value string").write.text(out)
    rows = RD.read_json_concat(spark, out, "a int", skip_bad=False, corrupt="bad").collect()
    assert sorted((r.a or 0, r.bad) for r in rows) == [(0, "{broken"), (1, None), (3, None)]
    assert RD.read_json_concat(spark, out, "a int").count() == 2


def test_whole_table_overwrite_drops_other_partitions(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    for write in (lambda d, o: W.write_parquet(d, o, partition_by=["p"]), lambda d, o: W.write_dataset(d, o, "overwrite", ["p"])):
        out = tmp("overwrite")
        write(df, out)
        write(df.where("p = 'a'"), out)
        assert [tuple(r) for r in spark.read.parquet(out).select("v", "p").collect()] == [(1, "a")]


def test_models_build_what_they_refer_to_first(spark):
    m = CAT.Models(spark, {"s": spark.range(3)})
    m.declare("b", lambda r: r.ref("a").selectExpr("id + 1 AS id"))
    m.declare("a", lambda r: r.ref("s").selectExpr("id * 10 AS id"))
    assert sorted(r.id for r in m.run()["b"].collect()) == [1, 11, 21]
    m.declare("x", lambda r: r.ref("y"))
    m.declare("y", lambda r: r.ref("x"))
    with pytest.raises(ValueError):
        m.run()


def test_materialized_data_of_a_scope_is_deleted(spark):
    import os
    from tidewater.session import materialize, scratch_scope
    with scratch_scope(spark):
        path = materialize(spark.range(5), "scoped").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


# ---------------------------------------------------------------- quoted CSV
def _files(spark, path, **texts):
    """Files of exactly these texts, as ``path/<name>.csv``."""
    import os
    os.makedirs(path)
    for name, text in texts.items():
        with open(f"{path}/{name}.csv", "w", newline="") as f:
            f.write(text)
    return path


@pytest.mark.parametrize("multi_line", [False, True])
def test_quoted_header_names_and_cells(spark, tmp, multi_line):
    out = _files(spark, tmp("quoted"), a='"a,x",b,c\n1,2,3\n', b='\n\nC , "B"\r\n"3,""3""",2\r\n', c='\ufeffb\n5\n\n')
    got = RD.read_csv_by_name(spark, out, "b int, c string, `a,x` int", multi_line=multi_line).collect()
    assert sorted((r.b, r.c, r["a,x"]) for r in got) == [(2, "3", 1), (2, '3,"3"', None), (5, None, None)]


def test_quoted_line_breaks(spark, tmp):
    out = _files(spark, tmp("breaks"), a='id,"no\nte",z\n1,"line ""one""\nline, two",5\n2,plain,6\n', b='Z,ID\n1,3\n')
    schema = "id int, `no\nte` string, z int"
    with pytest.raises(ValueError, match="multi_line"):
        RD.read_csv_by_name(spark, out, schema)
    got = sorted(tuple(r) for r in RD.read_csv_by_name(spark, out, schema, multi_line=True).collect())
    assert got == [(1, 'line "one"\nline, two', 5), (2, "plain", 6), (3, None, 1)]


def test_an_unclosed_quote_is_refused(spark, tmp):
    out = _files(spark, tmp("unclosed"), a='id,note\n1,"never closed\n2,x\n')
    for multi_line in (False, True):
        with pytest.raises(ValueError, match="a.csv"):
            RD.read_csv_by_name(spark, out, "id int, note string", multi_line=multi_line)


def test_quotes_that_are_no_open_cell_are_read(spark, tmp):
    out = _files(spark, tmp("inch"), a='id,note,z\n1,"x,""",5\n2,"5"" pipe",6\n3,5" pipe,7\n5,"","9"\n6,"' + '""' * 20_001 + '",1\n')
    got = sorted(tuple(r) for r in RD.read_csv_by_name(spark, out, "id int, note string, z int").collect())
    assert got[:4] == [(1, 'x,"', 5), (2, '5" pipe', 6), (3, '5" pipe', 7), (5, None, 9)] and len(got[4][1]) == 20_001


def test_copy_into_takes_any_glob_and_catches_up(spark, tmp):
    from tidewater.sources import loads as LD
    src = tmp("globs")
    for folder in ("x", "y"):
        _files(spark, f"{src}/{folder}", p1="id\n1\n", p2="id\n2\n", q1="id\n3\n")
    asof, n = "2024-02-01 00:00:00", lambda glob: LD.copy_into(spark, src, tmp("t"), "id int", tmp("l"), asof, glob=glob)
    assert [n(g) for g in ("p?.csv", "*.{csv,tsv}", "p[12].csv", "[!p]*.csv", "*")] == [4, 6, 4, 2, 6]
    target, log = tmp("refresh-target"), tmp("refresh-log")
    load = lambda **kw: LD.refresh(spark, src, target, "id int", log, asof, **kw)
    assert [load(prefix="x/"), load(prefix="x"), load(modified_after="2999-01-01 00:00:00"), load(modified_after="2000-01-01 00:00:00"), load()] == [3, 0, 0, 3, 0]
    assert LD.read_landing(spark, target).count() == 6
    with pytest.raises(ValueError):
        LD.copy_into(spark, src, target, "id int", log, asof, force=True, modified_after=asof)


def test_files_that_break_off_are_failed_and_the_others_sent(spark, tmp):
    import bz2
    import gzip
    import os
    out, lines = tmp("delivery"), "".join(f'{{"a": {i}}}\n' for i in range(5000)).encode()
    os.makedirs(f"{out}/sub")
    packed = gzip.compress(lines)
    files = {"whole.json": lines, "sub/whole.json.gz": packed, "two.json.gz": packed + packed, "b.json.bz2": bz2.compress(lines), "blank.json": b"\n\n",
             "empty.json": b"", "torn.json.gz": packed[:len(packed) // 2], "tail.json.gz": packed[:-5], "no.json.gz": b"this is no archive"}
    for name, data in files.items():
        with open(f"{out}/{name}", "wb") as f:
            f.write(data)
    good, failed = W.read_delivery(spark, out, "*.json*")
    assert sorted(os.path.basename(r.file_path) for r in failed.collect()) == ["no.json.gz", "tail.json.gz", "torn.json.gz"]
    report = W.delivery_report(good, failed)
    assert {os.path.basename(r.file_path): r.sent for r in report.where("failed = 0").collect()} == {
        "whole.json": 5000, "whole.json.gz": 5000, "two.json.gz": 10_000, "b.json.bz2": 5000}
    with pytest.raises(RuntimeError, match="3 file"):
        W.raise_on_failures(W.report_summary(report))


def test_a_table_has_the_columns_of_all_its_files(spark, tmp):
    root = tmp("crawl-union")
    spark.range(4).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{root}/t")
    spark.range(4).selectExpr("id").write.json(f"{root}/j")
    one = {r.table_name: r.status for r in CAT.catalog_path(spark, root, "crawl_union").collect()}
    assert one == {"t": "registered", "j": "registered"}
    spark.range(4, 6).selectExpr("id", "string(id) AS more", "7 AS p").write.mode("append").partitionBy("p").parquet(f"{root}/t")
    got = {r.table_name: (r.status, r.changes) for r in CAT.catalog_path(spark, root, "crawl_union").collect()}
    assert got == {"t": ("updated", "+ more string"), "j": ("unchanged", None)}
    t = spark.table("crawl_union.t")
    assert t.count() == 6 and t.where("more IS NOT NULL AND p = 7").count() == 2
    spark.range(1).selectExpr("id", "'x' AS more", "9 AS p").write.mode("append").partitionBy("p").parquet(f"{root}/t")
    assert [r.status for r in CAT.catalog_path(spark, root, "crawl_union").collect()] == ["unchanged"] * 2
    assert spark.table("crawl_union.t").where("p = 9").count() == 1         # its partition was recovered
    name = CAT.register_table(spark, f"{root}/t", "crawl_union", "again")
    assert spark.table(name).count() == 7 and spark.table(name).columns == ["id", "more", "p"]
    with pytest.raises(ValueError):
        CAT.register_table(spark, f"{root}/t", "crawl_union", "again", partition_by=("more",))


def test_glued_objects_leave_in_small_batches():
    """A task's files are split one by one: no batch holds all their objects."""
    import pyarrow as pa
    texts = ["".join(f'{{"a": {i}}}' for i in range(RD.SPLIT_RECORDS + 10)), "", '{"a": 1}' + '{"s": "' + "x" * RD.SPLIT_CHARS + '"}{bad']
    given = pa.RecordBatch.from_arrays([pa.array(["p", "q", "r"]), pa.array(texts)], ["path", "value"])
    got = [b.to_pydict() for b in RD._split_glued(iter([given, given]))]
    assert max(len(b["doc"]) for b in got) == RD.SPLIT_RECORDS
    assert [sum(len(b["doc"]) for b in got if b["path"][0] == p) for p in "pr"] == [2 * RD.SPLIT_RECORDS + 20, 6]
    assert "".join(d for b in got for d in b["doc"]) == 2 * "".join(texts)
    assert [d for b in got for d, g in zip(b["doc"], b["good"]) if not g] == ["{bad", "{bad"]


def test_one_file_per_partition_does_not_sort_its_rows(spark, tmp):
    """A task that writes several values keeps their files open: a sort would hold all its rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    rows = spark.range(3000).withColumn("p", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    out = W.write_one_file_per_partition(rows, tmp("onefile-open"), ["p"])
    assert spark.conf.get(key) == before
    assert spark.read.parquet(out).groupBy("p").count().where("count = 750").count() == 4
    assert RD.list_files(spark, out, suffix=".parquet").count() == 4
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    mine = [x for x in plans if out in x and "InsertIntoHadoopFsRelationCommand" in x]
    assert mine and not any("Sort" in x for x in mine)
