"""Quality gate, change capture and streaming properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import cdc as CDC
from tidewater.operators import quality as Q
from tidewater.streaming import streams as ST

ASOF = "2024-02-01 00:00:00"


def healthy(spark, n=20):
    return spark.createDataFrame(
        [(f"v{i}", "t", "c", i * 10, "us", dt.datetime(2024, 1, 31, 12)) for i in range(n)],
        "video_id string, title string, channel_title string, views long, region string, _processed_at timestamp")


def test_gate_passes_nine_of_nine_on_healthy_table(spark):
    checks, summary = Q.gate(spark, {"clean_statistics": healthy(spark)},
                             {"clean_statistics": {"critical": ["video_id", "title", "channel_title", "views", "region"],
                                                   "range_column": "views"}}, asof=ASOF)
    s = summary.first()
    assert (s.quality_passed, s.checks_passed, s.checks_total) == (True, 9, 9)


def test_gate_failures_and_unreadable_table(spark):
    bad = healthy(spark, 5).withColumn("views", F.lit(-1).cast("long")).drop("region")
    checks, summary = Q.gate(spark, {"t": bad, "gone": "/nonexistent/table"},
                             {"t": {"critical": ["video_id", "region"], "range_column": "views"}}, asof=ASOF)
    rows = {(r.check, r.column_name): r.passed for r in checks.collect()}
    assert rows[("row_count", None)] is False and rows[("null_pct", "region")] is False
    assert rows[("value_range", "views")] is False and rows[("read_table", None)] is False
    assert summary.first().quality_passed is False


def test_model_tests(spark):
    o = spark.createDataFrame([(1, "F", 1), (2, "X", 9), (2, "O", 1)], "k int, s string, c int")
    c = spark.createDataFrame([(1,)], "c int")
    res = {r.test_name: r.failures for r in Q.test_results({
        "unique": Q.unique(o, ["k"]), "accepted": Q.accepted_values(o, "s", ["F", "O"]),
        "rel": Q.relationships(o, c, "c", "c"), "nn": Q.not_null(o, "k")}).collect()}
    assert res == {"unique": 1, "accepted": 1, "rel": 1, "nn": 0}


def test_upsert_is_latest_per_key_and_replay_safe(spark, tmp):
    target = tmp("upsert")
    ch1 = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, v string")
    ch2 = spark.createDataFrame([(2, 5, "d"), (3, 1, "e")], "k int, t int, v string")
    CDC.merge_upsert(spark, target, ch1, "k", ["t"], buckets=4)   # two snapshots of key 1 in one batch
    CDC.merge_upsert(spark, target, ch2, "k", ["t"], buckets=4)
    CDC.merge_upsert(spark, target, ch1, "k", ["t"], buckets=4)   # replay of an old batch
    got = sorted(tuple(r) for r in CDC.current_state(spark, target).select("k", "t", "v").collect())
    assert got == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]


def test_a_correction_of_the_same_instant_wins(spark, tmp):
    target = tmp("correct")
    row = lambda v: spark.createDataFrame([(1, 1, v)], "k int, t int, v int")
    CDC.merge_upsert(spark, target, row(9), "k", ["t"], buckets=4)
    CDC.merge_upsert(spark, target, row(5), "k", ["t"], buckets=4)
    assert [tuple(r) for r in CDC.current_state(spark, target).select("k", "t", "v").collect()] == [(1, 1, 5)]


def test_another_bucket_count_is_refused(spark, tmp):
    target, rows = tmp("buckets"), spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("t"))
    CDC.merge_upsert(spark, target, rows, "k", ["t"], buckets=8)
    with pytest.raises(ValueError):
        CDC.merge_upsert(spark, target, rows, "k", ["t"], buckets=16)
    assert CDC.current_state(spark, target).count() == 50


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _people(spark, *rows, schema="k int, t int, v string"):
    return spark.createDataFrame(list(rows), schema)


def test_a_merge_that_breaks_off_leaves_the_old_table(spark, tmp, monkeypatch):
    target, rows = tmp("broken"), spark.range(60).selectExpr("id AS k", "1 AS t", "'old' AS v")
    CDC.merge_upsert(spark, target, rows, "k", ["t"], buckets=8)
    old = _rows(CDC.current_state(spark, target), "k", "t", "v")
    newer = rows.withColumn("t", F.lit(2)).withColumn("v", F.lit("new"))
    real = CDC._write

    def some_buckets(df, path):
        real(df.where(f"{CDC.BUCKET} < 4"), path)
        raise OSError("killed between two buckets")

    def no_manifest(*args):
        raise OSError("killed before the manifest")

    def half_a_manifest(spark, target, state):
        fs, p = CDC._fs(spark, f"{target}/{CDC.MANIFESTS}/{state['version']:012d}.json")
        out = fs.create(p, False)
        out.write(bytearray(b'{"version": 2, "buck'))
        out.close()
        raise OSError("killed while writing the manifest")
    for where, fault in (("_write", some_buckets), ("_commit", no_manifest), ("_commit", half_a_manifest)):
        with monkeypatch.context() as m:
            m.setattr(CDC, where, fault)
            with pytest.raises(OSError):
                CDC.merge_upsert(spark, target, newer, "k", ["t"], buckets=8)
        assert _rows(CDC.current_state(spark, target), "k", "t", "v") == old
    CDC.merge_upsert(spark, target, newer, "k", ["t"], buckets=8)
    assert _rows(CDC.current_state(spark, target), "k", "t", "v") == [(k, 2, "new") for k in range(60)]
    CDC.merge_upsert(spark, target, newer, "k", ["t"], buckets=8)
    assert len(CDC._names(spark, f"{target}/{CDC.DATA}")) == 2      # what broke off is gone


def test_a_reader_keeps_its_version(spark, tmp):
    target = tmp("snapshot")
    CDC.merge_upsert(spark, target, _people(spark, (1, 1, "a"), (2, 1, "b")), "k", ["t"], buckets=4)
    before = CDC.current_state(spark, target)
    CDC.merge_upsert(spark, target, _people(spark, (1, 2, "c")), "k", ["t"], buckets=4)
    assert _rows(before, "k", "v") == [(1, "a"), (2, "b")] == _rows(CDC.current_state(spark, target, 1), "k", "v")
    assert _rows(CDC.current_state(spark, target), "k", "v") == [(1, "c"), (2, "b")]
    CDC.merge_upsert(spark, target, _people(spark, (1, 3, "d")), "k", ["t"], buckets=4)
    assert CDC.versions(spark, target) == [3, 2]
    with pytest.raises(ValueError):
        CDC.current_state(spark, target, 1)
    assert _rows(CDC.current_state(spark, target, 2), "k", "v") == [(1, "c"), (2, "b")]


def test_of_two_merges_at_once_one_is_refused(spark, tmp, monkeypatch):
    target = tmp("race")
    CDC.merge_upsert(spark, target, _people(spark, (1, 1, "a")), "k", ["t"], buckets=4)
    real = CDC._write

    def meanwhile(df, path):
        monkeypatch.undo()
        CDC.merge_upsert(spark, target, _people(spark, (2, 1, "first")), "k", ["t"], buckets=4)
        real(df, path)
    monkeypatch.setattr(CDC, "_write", meanwhile)
    with pytest.raises(RuntimeError):
        CDC.merge_upsert(spark, target, _people(spark, (1, 2, "second")), "k", ["t"], buckets=4)
    assert _rows(CDC.current_state(spark, target), "k", "v") == [(1, "a"), (2, "first")]


def test_named_columns_are_updated_and_others_kept(spark, tmp):
    target, schema = tmp("cols"), "k int, t int, v string, w int"
    CDC.merge_upsert(spark, target, _people(spark, (1, 1, "a", 10), (2, 5, "b", 20), schema=schema), "k", ["t"], buckets=4)
    changes = _people(spark, (1, 2, "x", 99), (2, 4, "stale", 99), (3, 1, "new", 99), schema=schema)
    CDC.merge_upsert(spark, target, changes, "k", ["t"], buckets=4, cols=["v"])
    assert _rows(CDC.current_state(spark, target), "k", "t", "v", F.coalesce("w", F.lit(-1))) == [(1, 2, "x", 10), (2, 5, "b", 20), (3, 1, "new", -1)]
    with pytest.raises(ValueError, match="cols"):
        CDC.merge_upsert(spark, target, changes.drop("w"), "k", ["t"], buckets=4)


def test_a_new_column_is_refused_or_added(spark, tmp):
    target = tmp("evolve")
    CDC.merge_upsert(spark, target, _people(spark, (1, 1, "a"), (2, 1, "b")), "k", ["t"], buckets=4)
    wider = _people(spark, (1, 2, "c", 7), schema="k int, t int, v string, extra int")
    with pytest.raises(ValueError, match="extra"):
        CDC.merge_upsert(spark, target, wider, "k", ["t"], buckets=4)
    CDC.merge_upsert(spark, target, wider, "k", ["t"], buckets=4, evolve=True)
    assert _rows(CDC.current_state(spark, target), "k", "v", F.coalesce("extra", F.lit(0))) == [(1, "c", 7), (2, "b", 0)]
    CDC.merge_upsert(spark, target, _people(spark, (3, 1, "d")), "k", ["t"], buckets=4, cols=["v"])
    assert CDC.current_state(spark, target).columns == ["k", "t", "v", "extra"]


def test_null_keys_and_instants_merge(spark, tmp):
    target, schema = tmp("nulls"), "k int, j string, t int, v string"
    CDC.merge_upsert(spark, target, _people(spark, (None, "x", None, "a"), (1, None, 3, "b"), schema=schema), ["k", "j"], ["t"], buckets=4)
    CDC.merge_upsert(spark, target, _people(spark, (None, "x", 1, "c"), (1, None, None, "old"), (None, None, 1, "n"), schema=schema), ["k", "j"], ["t"], buckets=4)
    assert sorted(r.v for r in CDC.current_state(spark, target).collect()) == ["b", "c", "n"]
    with pytest.raises(ValueError):
        CDC.current_state(spark, tmp("nothing"))


def test_a_check_without_result_does_not_pass(spark):
    checks = spark.createDataFrame([("a", "t", None, None, None, True, ""), ("b", "t", None, None, None, None, "")], Q.CHECK_SCHEMA)
    s = Q.summarise(checks).first()
    assert (s.quality_passed, s.checks_passed, s.checks_total) == (False, 1, 2)


def test_a_batch_of_one_folder_is_written_by_several_tasks(spark, tmp):
    from tidewater.sources import writers as W
    out = tmp("one-hour")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        W.write_batch(spark.range(200_000, numPartitions=8).withColumn("hour", F.lit(3)).withColumn("x", F.sha2(F.col("id").cast("string"), 256)), out, 0, ["hour"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(out).inputFiles()
    assert len(files) > 1 and spark.read.parquet(out).count() == 200_000


def _readings(spark, inbox, minutes):
    base = dt.datetime(2024, 1, 1)
    rows = [(f"s{m % 3}", "co", 1.0, base + dt.timedelta(minutes=m, seconds=10), "shard-0", str(m)) for m in minutes]
    (spark.createDataFrame(rows, "location_id string, parameter_of_AQI string, value_of_AQI double, "
                                 "processing_time timestamp, shard_id string, sequence_number string")
     .coalesce(1).write.mode("append").json(inbox))


def test_tumbling_count_restart_and_late_rows(spark, tmp):
    inbox, out, ck = tmp("inbox"), tmp("out"), tmp("ck")
    _readings(spark, inbox, range(0, 5))
    ST.run_available_now(ST.tumbling_count(ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)), out, ck)
    _readings(spark, inbox, range(5, 10))
    ST.run_available_now(ST.tumbling_count(ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)), out, ck)
    _readings(spark, inbox, [0, 1])            # late: behind the watermark now
    with ST.counting_drops(spark) as late:
        ST.run_available_now(ST.tumbling_count(ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)), out, ck)
    got = sorted((r.window_end.minute, r.record_count) for r in spark.read.parquet(out).collect())
    # 10 one-minute windows; the last stays open (its end is after max(ts) - 5 s)
    assert got == [(m, 1) for m in range(1, 10)]
    assert late.dropped == 2


def test_dedup_within_watermark(spark, tmp):
    inbox, out, ck = tmp("dinbox"), tmp("dout"), tmp("dck")
    _readings(spark, inbox, range(0, 6))
    _readings(spark, inbox, range(0, 6))
    src = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)
    ST.run_available_now(ST.dedup_stream(src, ["shard_id", "sequence_number"], "processing_time", "1 hour"), out, ck)
    assert spark.read.parquet(out).count() == 6


def test_zero_windows(spark):
    counts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 1), 2), (dt.datetime(2024, 1, 1, 0, 4), 1)],
                                   "window_end timestamp, record_count long")
    got = [(r.window_end.minute, r.record_count) for r in ST.with_zero_windows(counts, 60).orderBy("window_end")
           .collect()]
    assert got == [(1, 2), (2, 0), (3, 0), (4, 1)]


def test_processing_time_stream_stop_and_resume(spark, tmp):
    inbox, out, ck = tmp("pt-inbox"), tmp("pt-out"), tmp("pt-ck")
    _readings(spark, inbox, range(0, 4))
    src = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA, max_bytes_per_trigger=1 << 20)
    q = ST.start_stream(ST.enrich(src), out, ck, every="1 second")
    q.processAllAvailable()
    q.stop()
    _readings(spark, inbox, range(4, 6))
    q = ST.start_stream(ST.enrich(ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)), out, ck, every="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == 6


def test_same_file_name_is_ignored_by_change_stream(spark, tmp):
    """K4: a correction under a new file name updates the key; a file delivered
    again under a name already processed is ignored (the source log is by name)."""
    import glob
    import os
    staging, target, ck = tmp("k4-staging"), tmp("k4-target"), tmp("k4-ck")
    schema = "k int, t int, v string"
    handler = CDC.change_batch_handler(spark, target, "k", ["t"], buckets=4)
    spark.createDataFrame([(1, 1, "a")], schema).coalesce(1).write.json(staging)
    ST.run_available_now(ST.read_stream_json(spark, staging, schema), handler, ck)
    # rewrite the processed file in place (same name) with a newer value: ignored
    (path,) = glob.glob(os.path.join(staging, "part-*.json"))
    with open(path, "w") as f:
        f.write('{"k": 1, "t": 9, "v": "same-name"}\n')
    ST.run_available_now(ST.read_stream_json(spark, staging, schema), handler, ck)
    assert [tuple(r) for r in CDC.current_state(spark, target).select("k", "t", "v").collect()] == [(1, 1, "a")]
    # the same correction under a new file name is applied
    spark.createDataFrame([(1, 9, "new-name")], schema).coalesce(1).write.mode("append").json(staging)
    ST.run_available_now(ST.read_stream_json(spark, staging, schema), handler, ck)
    assert [tuple(r) for r in CDC.current_state(spark, target).select("k", "t", "v").collect()] == [(1, 9, "new-name")]


# ---------------------------------------------------------------- rolling files
def _rolled(spark, tmp, lengths, max_records, max_bytes, **kw):
    """Sizes and records of the files that a batch of records of these text lengths rolls into."""
    import glob
    import os
    out, tasks = tmp("rolled"), 4
    rows = [(i, "x" * n, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "i int, s string, at timestamp").repartition(tasks)
    ST.rolling_json(out, max_records, max_bytes, **kw)(df, 0)
    ST.rolling_json(out, max_records, max_bytes, **kw)(df, 0)       # a replay
    assert sorted(r.i for r in spark.read.json(out).select("i").collect()) == list(range(len(rows)))
    files = glob.glob(f"{out}/batch_id=0/roll=*/part-*")
    return [(os.path.getsize(f), [r.i for r in spark.read.json(f).select("i").collect()]) for f in files]


def test_one_long_record_does_not_split_the_others(spark, tmp):
    files = _rolled(spark, tmp, [100] * 2000 + [1_000_000] + [100] * 2000, 10_000, 100_000)
    assert max(n for n, rows in files if len(rows) > 1) <= 100_000
    assert len(files) <= 10 and sum(n > 100_000 for n, _ in files) == 1


def test_files_close_by_count_size_and_time(spark, tmp):
    assert max(len(rows) for _, rows in _rolled(spark, tmp, [10] * 950, 100, 10**6)) <= 100
    files = _rolled(spark, tmp, [30, 900, 5000, 30_000, 60_000, 99_000] * 20, 10_000, 100_000)
    assert max(n for n, _ in files) <= 100_000 and len(files) <= 20 + 20 + 10 + 5 + 4
    files = _rolled(spark, tmp, [10] * 100, 10_000, 10**6, seconds=30, time_col="at")
    assert sorted(len(rows) for _, rows in files) == [10, 30, 30, 30] and all(len({i // 30 for i in rows}) == 1 for _, rows in files)
    with pytest.raises(ValueError):
        ST.rolling_json("x", 1, 1, seconds=30)


# ---------------------------------------------------------------- monitors
def test_a_batch_is_counted_while_it_is_logged(spark, tmp, monkeypatch):
    from tidewater.streaming import monitors as MON
    logs, summary = tmp("mon-logs"), tmp("mon-summary")
    handle = MON.monitor_handler(spark, logs, summary)
    batch = spark.createDataFrame([("eyJ3aW5kb3dfZW5kIjogIngifQ==",), ("bm8ganNvbg==",)], "data string")
    monkeypatch.setattr(type(spark), "read", property(lambda self: pytest.fail("the monitor reads nothing back")))
    for batch_id, rows in enumerate((batch, batch.limit(0), batch.limit(1))):
        handle(rows, batch_id)
    handle(batch, 0)        # a replay
    monkeypatch.undo()
    got = spark.read.parquet(summary)
    assert _rows(got, "batch_id", "received", "status") == [(0, 2, "ok"), (1, 0, "heartbeat"), (2, 1, "ok")]
    assert got.where("summarised_at IS NULL").count() == 0 and spark.read.parquet(logs).count() == 3


# ---------------------------------------------------------------- start positions
LOG_SCHEMA = "shard_id string, sequence_number string, v int"


def _append(spark, log, a, b, rows=7):
    from tidewater.streaming import shards as SH
    SH.append_segments(spark.range(a, b).selectExpr("concat('s/+', id % 3) AS shard_id", "string(id) AS sequence_number", "int(id) AS v"), log, segment_rows=rows)


def _consume(spark, log, place, start="earliest"):
    from tidewater.streaming import shards as SH
    ST.run_available_now(SH.read_shards(spark, log, LOG_SCHEMA, start), f"{place}/out", f"{place}/ckpt")
    return sorted(r.v for r in spark.read.schema("v int").parquet(f"{place}/out").collect())


def test_consumers_start_where_they_ask_and_go_on_at_their_checkpoint(spark, tmp):
    log, places = tmp("log"), [tmp(f"consumer-{i}") for i in range(3)]
    _append(spark, log, 0, 100)
    assert _consume(spark, log, places[0]) == list(range(100))
    assert _consume(spark, log, places[1], "latest") == []
    after = {"s/+0": 50, "s/+1": 10_000}
    assert _consume(spark, log, places[2], after) == [v for v in range(100) if v % 3 == 2 or v % 3 == 0 and v > 50]
    _append(spark, log, 100, 130)
    assert _consume(spark, log, places[0], "latest") == list(range(130))         # its checkpoint counts, not the start
    assert _consume(spark, log, places[1], "latest") == list(range(100, 130))
    assert _consume(spark, log, places[1], "latest") == list(range(100, 130))
    assert max(_consume(spark, log, places[2], after)) == 129


def test_a_shard_that_comes_later_is_read_from_its_first_record(spark, tmp):
    from tidewater.streaming import shards as SH
    log, place = tmp("log-new"), tmp("consumer-new")
    _append(spark, log, 0, 30)
    assert _consume(spark, log, place, "latest") == []
    SH.append_segments(spark.createDataFrame([("new", "1", 1000), ("new", "2", 1001)], LOG_SCHEMA), log)
    assert _consume(spark, log, place, "latest") == [1000, 1001]


def test_segments_hold_their_shards_records_in_order(spark, tmp):
    log = tmp("log-order")
    _append(spark, log, 0, 100)
    files = spark.read.text(log).select("shard", "segment", "last", F.get_json_object("value", "$.v").cast("int").alias("v")).collect()
    by = {}
    for r in files:
        by.setdefault((r.shard, int(r.segment)), []).append((r.v, int(r["last"])))
    assert all(len(rows) <= 7 and max(v for v, _ in rows) == rows[0][1] for rows in by.values())
    assert [v for (shard, _), rows in sorted(by.items()) if shard == "s/+1" for v, _ in sorted(rows)] == list(range(1, 100, 3))


def test_lines_that_do_not_parse_are_dropped_or_kept(spark, tmp):
    from tidewater.streaming import shards as SH
    log = tmp("log-bad")
    spark.createDataFrame([('{"shard_id": "a", "sequence_number": "1", "v": 1}', "a", "000000000000", "1"), ("{torn", "a", "000000000000", "1")],
                          "value string, shard string, segment string, last string").coalesce(1).write.partitionBy("shard", "segment", "last").text(log)
    assert _consume(spark, log, tmp("consumer-bad")) == [1]
    out = tmp("kept")
    ST.run_available_now(SH.read_shards(spark, log, LOG_SCHEMA, skip_bad=False), out, tmp("kept-ckpt"))
    assert [r[0] for r in spark.read.parquet(out).where("v IS NULL").select("_corrupt_record").collect()] == ["{torn"]
    with pytest.raises(ValueError):
        SH.read_shards(spark, log, LOG_SCHEMA, "newest")


# ---------------------------------------------------------------- failures in the middle of a batch
def test_a_batch_that_fails_once_gives_the_same_rows(spark, tmp):
    from pyspark.errors import StreamingQueryException
    from tidewater.sources import writers as W
    inbox = tmp("fault-inbox")
    for part in range(4):
        _readings(spark, inbox, range(part * 10, part * 10 + 10))
    results = []
    for fault in (None, "before", "after"):
        out, ck, calls = tmp("fault-out"), tmp("fault-ck"), []

        def write(batch, batch_id):
            calls.append(batch_id)
            broken = fault and calls.count(2) == 1 and batch_id == 2
            if broken and fault == "before":
                raise RuntimeError("before the write")
            W.write_batch(batch, out, batch_id)
            if broken:
                raise RuntimeError("between write and commit")
        src = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA, max_files_per_trigger=1)
        run = lambda: ST.run_available_now(ST.tumbling_count(src), write, ck)
        if fault:
            with pytest.raises(StreamingQueryException):
                run()
        run()
        results.append(_rows(spark.read.parquet(out), "window_end", "record_count"))
        assert calls.count(2) == (2 if fault else 1)
    assert results[0] == results[1] == results[2] and results[0]


def test_a_file_sink_whose_task_fails_shows_nothing_of_that_batch(spark, tmp):
    from pyspark.errors import StreamingQueryException
    inbox, out, ck = tmp("sink-inbox"), tmp("sink-out"), tmp("sink-ck")
    for part in range(4):
        _readings(spark, inbox, range(part * 10, part * 10 + 10))
    src = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA, max_files_per_trigger=1)
    torn = src.withColumn("unit", F.when(F.col("sequence_number") == "25", F.raise_error(F.lit("fault"))).otherwise(F.col("unit")))
    with pytest.raises(StreamingQueryException):
        ST.run_available_now(torn, out, ck)
    seen = _rows(spark.read.parquet(out), F.col("sequence_number").cast("int"))
    assert all(x[0] // 10 != 2 for x in seen)
    ST.run_available_now(src, out, ck)
    assert _rows(spark.read.parquet(out), F.col("sequence_number").cast("int")) == [(i,) for i in range(40)]


# ---------------------------------------------------------------- batches of a run over an inbox
def test_batches_do_not_grow_with_the_inbox(spark, tmp, monkeypatch):
    """60 files are read in as many batches as 600 would be, each of them once."""
    from functools import partial
    from tidewater.plans import queries_stream as QS
    sf, made = tmp("inbox-tables"), []
    spark.range(60).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts", "id % 3 AS user_id", "'a' AS event_type",
                               "double(id) AS value", "'{}' AS props").coalesce(1).write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(QS, "_write_readings", partial(QS._write_readings, records_per_file=1))
    fresh = QS.scratch_dir
    monkeypatch.setattr(QS, "scratch_dir", lambda s, name: made.append((name, fresh(s, name))) or made[-1][1])
    row = QS.j6_continuous_global_avg(spark, sf).first()
    assert (row.avg_value, row.n) == (29.5, 60)
    commits = spark.read.format("binaryFile").load(f"{dict(made)['j6-ckpt']}/commits").count()
    assert 3 <= commits <= QS.BATCHES + 1


def test_merges_do_not_grow_with_the_staging_files(spark, tmp, monkeypatch):
    """A drop of 8 files takes as many merges as one of 80 would, each change is merged."""
    from tidewater.plans import queries_stream as QS
    sf, changes = tmp("staging-tables"), QS._changes
    spark.range(64).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts", "id % 5 AS user_id", "'a' AS event_type",
                               "double(id) AS value", "'{}' AS props").coalesce(1).write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(QS, "_changes", lambda e: changes(e).repartition(8))
    monkeypatch.setattr(QS, "BATCHES", 3)
    target, log = QS._staging_stream(spark, sf, "merges", [F.lit(True)], max_files=1)
    assert spark.read.parquet(log).count() == 3
    assert _rows(QS.CDC.current_state(spark, target), "user_id", "event_id") == [(0, 60), (1, 61), (2, 62), (3, 63), (4, 59)]


def test_small_segments_share_a_task(spark, tmp, monkeypatch):
    """A reader plans tasks by bytes: 99 segments are few tasks, each record is read once."""
    from tidewater.streaming import shards as SH
    log = tmp("log-many")
    _append(spark, log, 0, 297, rows=3)
    reader = SH.ShardReader({"path": log})
    end = reader.latestOffset()
    tasks = reader.partitions({}, end)
    assert sum(end.values()) == 99 and len(tasks) == 3
    assert sorted(n for t in tasks for n, _ in t.files) == sorted(3 * list(range(33)))
    lines = [(s, n, x) for t in tasks for b in reader.read(t) for s, n, x in zip(*b.to_pydict().values())]
    assert len(lines) == 297 and len({(s, n) for s, n, _ in lines}) == 99
    monkeypatch.setattr(SH, "SPLIT", 1)
    assert len(reader.partitions({}, end)) == 99        # a segment that fills a split is a task of its own
    assert [f for t in reader.partitions({s: 31 for s in end}, end) for f in t.files] == [f for t in tasks for f in t.files if f[0] >= 31]
