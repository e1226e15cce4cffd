"""File-level loads with a load history.

``copy_into`` appends each file once.  The history is keyed on a file's whole
path and holds one row for each listed file, also for one without data rows.

A load writes three things in turn: its files as ``LOADING`` under a new load id,
the data in a partition of that id, the files again as ``LOADED``.  A load that
broke off has no second mark: the next one removes its partition first and loads
its files again, whatever has arrived meanwhile.

``force=True`` loads every listed file again and replaces what was there: its
files are marked ``RELOADED``, and partitions of loads before it are removed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.columns import file_basename
from tidewater.session import delete_path, materialize, scratch_scope
from tidewater.sources.readers import list_files, read_csv_by_name

LOG_SCHEMA = ("load_id string, file_path string, file_name string, row_count long, loaded_at timestamp, "
              "status string, seq long")
LOAD_ID = "_load_id"
DONE = ("LOADED", "RELOADED")


def _log(spark: SparkSession, log_path: str) -> DataFrame:
    """The history; a log not yet written is empty."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(log_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def _loads(spark: SparkSession, log_path: str) -> list:
    """One row for each load: id, order, whether it was finished, whether it replaced what was before."""
    return (_log(spark, log_path).groupBy("load_id", "seq")
            .agg(F.bool_or(F.col("status").isin(*DONE)).alias("done"), F.bool_or(F.col("status") == "RELOADED").alias("reload"))
            .orderBy("seq").collect())


def _sweep(spark: SparkSession, target: str, loads: list) -> list[str]:
    """Remove partitions of broken-off and of replaced loads; returns the ids that count."""
    last = max((r["seq"] for r in loads if r["reload"] and r["done"]), default=-1)
    for r in loads:
        if not r["done"] or r["seq"] < last:
            delete_path(spark, f"{target}/{LOAD_ID}={r['load_id']}")
    return [r["load_id"] for r in loads if r["done"] and r["seq"] >= last]


def copy_into(spark: SparkSession, source: str, target: str, schema: str | StructType, log_path: str,
              loaded_at: str, force: bool = False, glob: str = "*.csv", multi_line: bool = False,
              modified_after: str | None = None) -> int:
    """Append new files by column name; returns the number of files loaded.

    ``glob`` is matched against file names by the reader's own listing, so whatever Spark accepts
    (``?``, ``[ab]``, ``{csv,tsv}``) loads what it matches.  ``modified_after`` (an instant, as text)
    leaves out files that are not younger."""
    if force and modified_after is not None:
        raise ValueError("force replaces the whole table, so it cannot leave out older files")
    with scratch_scope(spark):
        loads = _loads(spark, log_path)
        unknown = _partitions(spark, target) - {r["load_id"] for r in loads}
        if unknown:
            raise ValueError(f"{target} holds loads that {log_path} does not know: {sorted(unknown)}")
        _sweep(spark, target, loads)
        listed = list_files(spark, source, glob=glob).select("path", "modification_time")
        if modified_after is not None:
            listed = listed.where(F.col("modification_time") > F.lit(modified_after).cast("timestamp"))
        if not force:
            done = _log(spark, log_path).where(F.col("status").isin(*DONE)).select(F.col("file_path").alias("path")).distinct()
            listed = listed.join(done, "path", "left_anti")
        new = materialize(listed, "new-files")
        # a little before the oldest of them, in UTC
        before = F.to_utc_timestamp(F.min("modification_time") - F.make_interval(secs=F.lit(2)), F.current_timezone())
        oldest = F.date_format(before, "yyyy-MM-dd'T'HH:mm:ss")
        n, since = new.agg(F.count(F.lit(1)), oldest).first()
        if not n:
            return 0
        load_id, seq = uuid.uuid4().hex, max((r["seq"] for r in loads), default=0) + 1

        def entries(status: str, counts: DataFrame | None = None) -> DataFrame:
            rows = new.select(F.col("path").alias("file_path"))
            rows = rows.join(counts, "file_path", "left") if counts is not None else rows.withColumn("row_count", F.lit(None).cast("long"))
            return rows.select(F.lit(load_id).alias("load_id"), "file_path", file_basename("file_path").alias("file_name"),
                               F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
                               F.lit(loaded_at).cast("timestamp").alias("loaded_at"), F.lit(status).alias("status"),
                               F.lit(seq).cast("long").alias("seq"))
        entries("LOADING").write.mode("append").parquet(log_path)
        # the new files by their paths; the reader only lists what is as young as the oldest of them
        rows = read_csv_by_name(spark, source, schema, glob, files=new.select("path"), keep_file="_file", not_before=since, multi_line=multi_line)
        (rows.withColumnRenamed("_file", "_file_path").withColumn(LOAD_ID, F.lit(load_id))
         .write.mode("append").partitionBy(LOAD_ID).parquet(target))
        counts = (spark.read.parquet(f"{target}/{LOAD_ID}={load_id}") if load_id in _partitions(spark, target) else rows.withColumnRenamed("_file", "_file_path").limit(0)) \
            .groupBy(F.col("_file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
        entries("RELOADED" if force else "LOADED", counts).write.mode("append").parquet(log_path)
        _sweep(spark, target, _loads(spark, log_path))
        return n


def refresh(spark: SparkSession, source: str, target: str, schema: str | StructType, log_path: str, loaded_at: str,
            prefix: str = "", modified_after: str | None = None, glob: str = "*.csv", multi_line: bool = False) -> int:
    """Catch up after a pause, for the files of one folder below ``source`` and younger than an
    instant; files that the history knows are not loaded again.  Returns the number of files loaded."""
    folder = f"{source.rstrip('/')}/{prefix.strip('/')}" if prefix.strip("/") else source
    return copy_into(spark, folder, target, schema, log_path, loaded_at, glob=glob, multi_line=multi_line, modified_after=modified_after)


def _partitions(spark: SparkSession, target: str) -> set[str]:
    """Load ids that the target has a partition of."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return {n.removeprefix(f"{LOAD_ID}=") for n in names if n.startswith(f"{LOAD_ID}=")}


def read_landing(spark: SparkSession, target: str) -> DataFrame:
    """The landed table without its load-id partition and file columns."""
    return spark.read.parquet(target).drop(LOAD_ID, "_file_path")


def load_history(spark: SparkSession, log_path: str, asof: str, minutes: int = 15) -> DataFrame:
    """Files whose load was finished in the ``minutes`` before ``asof``, newest first."""
    cutoff = F.lit(asof).cast("timestamp") - F.make_interval(mins=F.lit(minutes))
    return (_log(spark, log_path).where(F.col("status").isin(*DONE) & (F.col("loaded_at") >= cutoff))
            .select("file_name", "file_path", "row_count", "loaded_at", "status")
            .orderBy(F.col("loaded_at").desc(), "file_path"))
