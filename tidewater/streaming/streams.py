"""Structured Streaming building blocks.

Sources are file streams (JSON / CSV / Parquet folders) with a checkpoint per
consumer; the same code reads Kafka when its connector is on the class path.
Runs used by the registry and tests use ``trigger(availableNow=True)``: every
file present at start is processed exactly once, the watermark closes windows
in a final no-data batch, and a rerun on the same checkpoint only sees new
files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions import columns as C
from tidewater.session import materialize, scratch_scope
from tidewater.sources.writers import json_text

# The sensor source's 13 data fields + 3 stream metadata fields.
SENSOR_FIELDS = ("location_id string, location_name string, parameter_of_AQI string, value_of_AQI double, "
                 "unit string, timezone string, latitude double, longitude double, country_iso string, "
                 "isMobile boolean, isMonitor boolean, owner_name string, provider string")
SENSOR_SCHEMA = SENSOR_FIELDS + ", processing_time timestamp, shard_id string, sequence_number string"
SENSOR_DATA_COLUMNS = [f.strip().split(" ")[0] for f in SENSOR_FIELDS.split(",")]
# The second source definition with plain names.
PLAIN_SCHEMA = ("location_id string, location_name string, parameter string, value double, unit string, "
                "processing_time timestamp, shard_id string, sequence_number string")

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: str | StructType, spark: SparkSession) -> StructType:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if CORRUPT not in st.fieldNames():
        st = StructType(st.fields + [StructField(CORRUPT, StringType(), True)])
    return st


def read_stream_json(spark: SparkSession, path: str, schema: str | StructType, skip_bad: bool = True,
                     max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
                     glob: str | None = None,
                     latest_first: bool = False, max_file_age: str | None = None,
                     clean_source: str | None = None, archive_dir: str | None = None) -> DataFrame:
    """Typed JSON stream, oldest files first; malformed records
    are parsed into ``_corrupt_record`` and dropped when ``skip_bad``."""
    st = _with_corrupt(schema, spark)
    r = (spark.readStream.schema(st).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("latestFirst", str(latest_first).lower()))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        # B6 size bound (a plain byte count, e.g. 5 * 1024 * 1024 for "5 MB")
        r = r.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_file_age:
        r = r.option("maxFileAge", max_file_age)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    df = r.json(path)
    if skip_bad:
        df = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return df


def read_kafka(spark: SparkSession, servers: str, topic: str, schema: str, from_start: bool = True) -> DataFrame:
    """A17 over Kafka (needs the spark-sql-kafka package on the class path)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", "earliest" if from_start else "latest").load())
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r"),
                        F.col("timestamp").alias("processing_time"),
                        F.col("partition").cast("string").alias("shard_id"),
                        F.col("offset").cast("string").alias("sequence_number"))
    return parsed.where(F.col("r").isNotNull()).select("r.*", "processing_time", "shard_id", "sequence_number")


def enrich(df: DataFrame, value: str = "value_of_AQI", parameter: str = "parameter_of_AQI") -> DataFrame:
    """The 13 data fields, plus the upper-cased parameter and the
    rescaled value; stream metadata is not selected."""
    return df.select(*SENSOR_DATA_COLUMNS,
                     F.upper(F.col(parameter)).alias("parameter_uppercase"),
                     C.rescale(F.col(value)).alias("value_in_fahrenheit"))


def tumbling_count(df: DataFrame, ts: str = "processing_time", width: str = "1 minute",
                   lateness: str = "5 seconds") -> DataFrame:
    """``(window_end, record_count)`` per tumbling window; in append mode
    a window is emitted once, when the watermark passes its end."""
    return (df.withWatermark(ts, lateness).groupBy(F.window(ts, width))
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(F.col("window.end").alias("window_end"), "record_count"))


def sliding_count(df: DataFrame, ts: str, width: str, slide: str, lateness: str = "5 seconds") -> DataFrame:
    """Counts per sliding window."""
    return (df.withWatermark(ts, lateness).groupBy(F.window(ts, width, slide))
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "record_count"))


def session_count(df: DataFrame, ts: str, key: str, gap: str, lateness: str = "5 seconds") -> DataFrame:
    """Counts per session of ``key`` (a session ends after ``gap`` without events)."""
    return (df.withWatermark(ts, lateness).groupBy(key, F.session_window(ts, gap))
            .agg(F.count(F.lit(1)).alias("record_count"))
            .select(key, F.col("session_window.start").alias("session_start"),
                    F.col("session_window.end").alias("session_end"), "record_count"))


def window_monitors(df: DataFrame, ts: str, width: str, value: str, station: str, flag: Column,
                    threshold: float, lateness: str = "5 seconds", exact_distinct: bool = False) -> DataFrame:
    """Per-window count above a threshold, avg/min/max, distinct stations and
    the share of a boolean flag.

    ``exact_distinct`` chains two aggregations, first (window, station), then
    window: a window's state is one row of counts for each station, spread over
    tasks by both, and never a set in one row (streams reject ``count(DISTINCT)``).
    Otherwise the distinct count is HyperLogLog's."""
    src = df.withWatermark(ts, lateness) if df.isStreaming else df
    if exact_distinct:
        each = (src.groupBy(F.window(ts, width), F.col(station).alias("_station"))
                .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(value) > threshold).alias("above"),
                     F.sum(value).alias("total"), F.count(value).alias("known"), F.min(value).alias("least"),
                     F.max(value).alias("most"), F.sum(flag.cast("double")).alias("flagged"), F.count(flag).alias("judged")))
        return (each.groupBy(F.window(F.window_time("window"), width))
                .agg(F.sum("n").alias("record_count"), F.sum("above").alias("above_threshold"),
                     F.try_divide(F.sum("total"), F.sum("known")).alias("avg_value"), F.min("least").alias("min_value"),
                     F.max("most").alias("max_value"), F.count("_station").alias("stations"),
                     F.try_divide(F.sum("flagged"), F.sum("judged")).alias("flag_share"))
                .select(F.col("window.end").alias("window_end"), "record_count", "above_threshold", "avg_value",
                        "min_value", "max_value", "stations", "flag_share"))
    distinct = F.approx_count_distinct(station)
    return (src.groupBy(F.window(ts, width))
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.count_if(F.col(value) > threshold).alias("above_threshold"),
                 F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
                 distinct.alias("stations"), F.avg(flag.cast("double")).alias("flag_share"))
            .select(F.col("window.end").alias("window_end"), "record_count", "above_threshold", "avg_value",
                    "min_value", "max_value", "stations", "flag_share"))


def with_zero_windows(counts: DataFrame, width_seconds: int, time_col: str = "window_end",
                      count_col: str = "record_count") -> DataFrame:
    """Add the windows that saw no records (count 0) between the first and
    last emitted window.

    The full window grid is ``spark.range`` over the number of windows between the
    first and the last end (two values read once), so it is built by many tasks
    and left-joined to the counts.
    """
    micros = width_seconds * 1_000_000
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    lo, hi = counts.agg(F.min(at), F.max(at)).first()
    kind = counts.schema[time_col].dataType
    n = 0 if lo is None else (hi - lo) // micros + 1
    grid = counts.sparkSession.range(n).select(
        F.timestamp_micros(F.lit(lo or 0) + F.col("id") * F.lit(micros)).cast(kind).alias(time_col))
    return (grid.join(counts, time_col, "left")
            .select(time_col, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col)))


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, lateness: str = "5 seconds") -> DataFrame:
    """Drop repeated ``keys`` (e.g. shard + sequence number) within the watermark."""
    return df.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def _writer(df: DataFrame, sink: str | Callable, checkpoint: str, output_mode: str, fmt: str,
            partition_by: Sequence[str] | None, max_records_per_file: int | None, name: str | None):
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if callable(sink):
        return w.foreachBatch(sink)
    w = w.format(fmt).option("path", sink)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w


#: Records of at most this share of a file's bytes fill files up to the rest of it; longer ones than the last go alone.
ROLL_SHARES = (1 / 8, 1 / 2)


def rolling_json(path: str, max_records: int, max_bytes: int, seconds: int | None = None, time_col: str | None = None) -> Callable:
    """A ``foreachBatch`` sink of JSON lines whose files close at a record count, a size or
    after some time, whichever comes first.

    The bytes and records before each record are summed, inside its task and over the tasks before it,
    and divided by what a file takes; the quotient is the record's file.  A file takes ``max_bytes`` less the longest
    record that may begin in it, so none grows beyond the limit: records of up to an eighth of it fill
    files to seven eighths, those of up to a half to one half, each of the longer ones is a file of its own (and only one
    longer than ``max_bytes`` makes a larger file).  No record decides the size of other records' files.

    A file holds records of one batch: with a trigger of 30 seconds it closes then (:func:`start_stream`).  For runs that
    catch up, ``seconds`` closes files by the records' own arrival time ``time_col``.
    A batch's folder is replaced as a whole, so a replay does not add to it."""
    if (seconds is None) != (time_col is None):
        raise ValueError("seconds and time_col go together")

    def handle(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            slot = F.floor(F.unix_micros(F.col(time_col).cast("timestamp")) / (seconds * 1_000_000)) if seconds else F.lit(0)
            lines = batch.select(json_text(*[F.col(f"`{c}`") for c in batch.columns]).alias("value"), F.coalesce(slot, F.lit(-1)).cast("long").alias("slot"))
            size = F.octet_length("value") + 1
            kind = F.when(size <= max_bytes * ROLL_SHARES[0], 0).when(size <= max_bytes * ROLL_SHARES[1], 1).otherwise(2)
            lines = lines.select("*", size.alias("size"), kind.alias("kind"), F.monotonically_increasing_id().alias("at"))
            lines = materialize(lines.withColumn("task", F.shiftright("at", 33)), "rolling")
            group = ["slot", "kind"]
            per = lines.groupBy(*group, "task").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
            before = Window.partitionBy(*group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)      # a row for each task
            per = per.select(*group, "task", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "records")])
            inside = Window.partitionBy(*group, "task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
            start = F.col("bytes_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
            index = F.col("records_before") + F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0))
            room = F.when(F.col("kind") == 0, max_bytes * (1 - ROLL_SHARES[0])).otherwise(max_bytes * (1 - ROLL_SHARES[1]))
            by_size = F.when(F.col("kind") == 2, index).otherwise(F.floor(start / room))
            name = F.concat_ws("-", *[x.cast("string") for x in (F.col("slot"), F.col("kind"), by_size, F.floor(index / max_records))])
            files = lines.join(per, [*group, "task"]).select("value", "at", name.alias("roll"))
            (files.repartition("roll").sortWithinPartitions("roll", "at").drop("at")
             .write.mode("overwrite").partitionBy("roll").text(f"{path}/batch_id={batch_id}"))
    return handle


def run_available_now(df: DataFrame, sink: str | Callable, checkpoint: str, output_mode: str = "append",
                      fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                      max_records_per_file: int | None = None, name: str | None = None) -> StreamingQuery:
    """Process everything available now, then stop (exactly once per file).

    ``sink`` is a path (file sink with its commit log: output is visible only
    when a batch commits) or a ``foreachBatch`` function.  Rows are written by the
    tasks that hold them: a folder that takes a whole batch is no one task's work.
    """
    q = _writer(df, sink, checkpoint, output_mode, fmt, partition_by, max_records_per_file, name) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def start_stream(df: DataFrame, sink: str | Callable, checkpoint: str, every: str = "10 seconds",
                 output_mode: str = "append", fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                 max_records_per_file: int | None = None, name: str | None = None) -> StreamingQuery:
    """A long-running query with a processing-time trigger (flush
    every ``every``; checkpoint and commit per batch).  Stop it with
    ``query.stop()``; restarting on the same checkpoint resumes (J13)."""
    return _writer(df, sink, checkpoint, output_mode, fmt, partition_by, max_records_per_file, name) \
        .trigger(processingTime=every).start()


class DropCounter(StreamingQueryListener):
    """Rows that stateful operators dropped as late, summed over every batch of every query.

    A listener sees each batch once; a query's own progress list keeps only the last ones.
    """

    def __init__(self):
        self.dropped = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.dropped += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


@contextmanager
def counting_drops(spark: SparkSession):
    """A :class:`DropCounter` for the queries run inside."""
    counter = DropCounter()
    spark.streams.addListener(counter)
    try:
        yield counter
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(counter)


def archive_layout(df: DataFrame, ts: str = "processing_time") -> DataFrame:
    """Add arrival-time folder columns ``year/month/day/hour``."""
    return df.select("*", F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
                     F.date_format(ts, "dd").alias("day"), F.date_format(ts, "HH").alias("hour"))


def status(q: StreamingQuery) -> dict:
    """State of a query."""
    return {"active": q.isActive, "message": q.status.get("message"), "last_batch": (q.lastProgress or {}).get("batchId")}


def pending_files(listed: DataFrame, landed: DataFrame, path: str = "path", source: str = "source_file") -> DataFrame:
    """Files of a listing that no landed row comes from yet."""
    return listed.join(landed.select(F.col(source).alias(path)).distinct(), path, "left_anti")
