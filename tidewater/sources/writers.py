"""Sinks: Parquet / CSV / JSON writers, idempotent partition
replacement, one file per partition, message framing and the delivery report."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import materialize

# JSON text keeps microseconds (Spark's default JSON timestamp format stops at milliseconds).
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


#: Files that a task of :func:`write_one_file_per_partition` writes at once.
OPEN_FILES = 8


def json_text(*cols) -> "F.Column":
    """Row -> JSON object text with microsecond timestamps."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, compression: str = "snappy") -> str:
    """B1: whole-table write (overwrite by default: old partitions go too), optionally Hive-partitioned."""
    w = df.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_idempotent(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """B2: replace only the partitions present in ``df``; others are kept.
    Running it twice with the same input leaves the same files as running it once."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy")
     .partitionBy(*partition_by)
     .parquet(path))
    return path


def write_dataset(df: DataFrame, path: str, mode: str = "append",
                  partition_by: Sequence[str] | None = None,
                  table: str | None = None, fmt: str = "parquet") -> str:
    """``append`` / ``overwrite`` / ``overwrite_partitions``; when ``table`` is
    given the table is registered (external, at ``path``) in the same call."""
    spark_mode = "overwrite" if mode in ("overwrite", "overwrite_partitions") else "append"
    w = df.write.mode(spark_mode).format(fmt)
    w = w.option("partitionOverwriteMode", "dynamic" if mode == "overwrite_partitions" else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return path


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                fmt: str = "parquet", **options: str) -> str:
    """Exactly-once output from ``foreachBatch``: rows are tagged with the batch id
    and the batch's own partitions are replaced (dynamic overwrite), so a replayed
    micro-batch rewrites the same folders instead of appending a second copy.

    ``rebalance`` evens out the files by size: few rows give one file, and a batch
    whose rows all belong to one folder is still written by many tasks."""
    keys = [*partition_by, "batch_id"]
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
     .hint("rebalance", *[F.col(k) for k in partition_by])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
     .partitionBy(*keys).format(fmt).save(path))
    return path


def write_one_file_per_partition(df: DataFrame, path: str, partition_by: Sequence[str],
                                 mode: str = "overwrite") -> str:
    """Exactly one file in each output partition folder.

    ``repartition(*keys)`` sends each partition value to one task in parallel,
    instead of funnelling the whole table through one task with ``coalesce(1)``.
    A partition value is one task's work by definition, so this is for small
    tables; large ones are written with :func:`write_rebalanced`.  A task keeps the
    files of a few values open at once instead of sorting its rows by value, so it does not
    hold them; only the rows of further values are sorted.
    """
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(max(OPEN_FILES, int(before))))
    try:
        (df.repartition(*[F.col(k) for k in partition_by]).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(path))
    finally:
        conf.set(key, before)
    return path


def write_rebalanced(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """B2 with even files: each partition value gets as many files as its size asks for."""
    return write_idempotent(df.hint("rebalance", *[F.col(k) for k in partition_by]), path, partition_by)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              index_col: str | None = None, order: Sequence[str] | None = None, compression: str = "none") -> str:
    """CSV with a header; optional 1-based row index column by ``order``.  Compressed files
    are named so (``*.csv.gz``)."""
    if index_col:
        from tidewater.operators.relational import global_rank
        df = global_rank(df, [F.col(c) for c in (order or df.columns)], index_col)
        df = df.select(index_col, *[c for c in df.columns if c != index_col])
    df.write.mode(mode).option("header", header).option("escape", '"').option("compression", compression).csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One JSON record per line."""
    df.write.mode(mode).options(**JSON_OPTIONS).json(path)
    return path


def to_ndjson(df: DataFrame, col: str = "value") -> DataFrame:
    """One JSON object text per row."""
    return df.select(json_text(*[F.col(f"`{c}`") for c in df.columns]).alias(col))


def to_messages(df: DataFrame, key: str | None, partitions: int | None = None,
                order: Sequence[str] = ()) -> DataFrame:
    """``(key, value)`` message rows.  With a key, rows of one key share a
    partition and keep ``order`` inside it; without, rows spread round-robin."""
    body = json_text(*[F.col(f"`{c}`") for c in df.columns]).alias("value")
    if key:
        out = df.select(F.col(key).cast("string").alias("key"), *order, body)
        out = out.repartition(partitions, "key") if partitions else out.repartition("key")
        out = out.sortWithinPartitions("key", *order)
        return out.select("key", "value")
    out = df.select(F.lit(None).cast("string").alias("key"), body)
    return out.repartition(partitions) if partitions else out


def _delivered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Executor side: the lines of each file, or, for one that does not unpack, the file alone.  Batches of
    files are bounded in bytes by Spark."""
    for b in batches:
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            try:
                codec = pa.Codec.detect(path).name
            except (TypeError, ValueError):      # no suffix of a compressed file
                codec = None
            try:
                data = content.as_buffer()
                text = pa.input_stream(data, compression=codec).read() if codec else data.to_pybytes()
                lines = [x for x in text.decode("utf-8", "replace").replace("\r\n", "\n").split("\n") if x] or [None]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string()), pa.array([True] * len(lines), pa.bool_())],
                                                 ["file_path", "value", "whole"])
            except (OSError, EOFError):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.string()), pa.array([False])], ["file_path", "value", "whole"])


def read_delivery(spark: SparkSession, path: str, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """``(file_path, value)`` of the record lines of all files that can be read, and the ``file_path`` of those that cannot.

    A file is read as a whole or not at all: of one that breaks off (a torn gzip file, say) no line counts, while
    Spark's own readers would pass what stands before the break.  A delivered file is bounded by its batch, a few
    MB.  Files that could not even be opened are what the listing has and the rows have not; empty files
    hold no records and are not failed."""
    from tidewater.sources.readers import list_files
    files = (spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
             .load(path).where("length > 0").select(F.col("_metadata.file_path").alias("file_path"), "content"))
    rows = materialize(files.mapInArrow(_delivered, "file_path string, value string, whole boolean"), "delivery")
    listed = list_files(spark, path, glob=glob).where("length > 0").select(F.col("path").alias("file_path"))
    whole = rows.where("whole").select("file_path", "value")
    return whole.where(F.col("value").isNotNull()), listed.join(whole.select("file_path"), "file_path", "left_anti")


def delivery_report(lines: DataFrame, unreadable: DataFrame | None = None, value_col: str = "value",
                    file_col: str = "file_path") -> DataFrame:
    """Per file ``(file_path, records, sent, skipped, failed)`` from raw record lines.

    A line that is not valid JSON is skipped, not sent.  A file fails when it could
    not be read (``unreadable``: its path) or when it holds records and none of
    them could be sent; a failed file counts once, and the others still go.
    """
    ok = F.try_parse_json(F.col(value_col)).isNotNull()
    out = (lines.groupBy(file_col)
           .agg(F.count(F.lit(1)).alias("records"), F.count_if(ok).alias("sent"),
                F.count_if(~ok).alias("skipped"))
           .withColumn("failed", (F.col("sent") == 0).cast("long")))
    if unreadable is not None:
        none = F.lit(0).cast("long")
        out = out.unionByName(unreadable.select(file_col, none.alias("records"), none.alias("sent"), none.alias("skipped"),
                                                F.lit(1).cast("long").alias("failed")))
    return out


def report_summary(report: DataFrame) -> DataFrame:
    """One run row: files, records, sent, skipped, failed files."""
    return report.agg(F.count(F.lit(1)).alias("files"), *[
        F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("records", "sent", "skipped", "failed")])


def raise_on_failures(summary: DataFrame) -> None:
    """After every file was tried, fail the run when any file failed."""
    row = summary.first()
    if row["failed"]:
        raise RuntimeError(f"{row['failed']} file(s) failed out of {row['files']}")
