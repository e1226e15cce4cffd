"""Sharded logs: a streaming source with a start position.

A log is a folder of shards.  Each append adds segments of JSON lines to them, numbered
without gaps: ``shard=<name>/segment=<number>/last=<largest sequence number>/<file>``.  So the
names alone tell how far a shard has come and where a sequence number lies, and no
record of an older segment is ever read.

A consumer starts at the earliest segment, behind the latest, or after a given sequence number of each
shard.  Its offsets are the next segment of every shard and live in the checkpoint: a
restart goes on where it stopped, whatever start was asked for.  Segments are
taken whole, each a file of its own.  A task reads as many neighbouring ones of a shard as fill
a split, so a busy shard is read by many tasks and small segments do not cost a task each.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.operators.relational import rank_within
from tidewater.sources.readers import list_files
from tidewater.sources.writers import json_text

EARLIEST, LATEST = "earliest", "latest"
LINES = 10_000          # records of one Arrow batch
SPLIT = 4 << 20         # bytes of segments that one task reads; a larger segment is a task of its own
FEW = 8                 # so many segments are looked up one by one, more of them by one listing of their shard


def append_segments(df: DataFrame, path: str, shard: str = "shard_id", sequence: str = "sequence_number", segment_rows: int = 10_000) -> None:
    """Append records to the log, each shard's in the order of its sequence numbers (whole numbers).

    Segments hold ``segment_rows`` records at most; one shard's records are written by as many tasks as they
    fill segments.  A log has one writer at a time."""
    spark = df.sparkSession
    number = F.col(sequence).cast("long")
    ranked = rank_within(df.withColumn("_number", number).withColumn("_shard", F.col(shard).cast("string")), ["_shard"], ["_number"], "_rank")
    try:
        files = list_files(spark, path).select(F.regexp_extract("path", "/shard=([^/]*)/segment=", 1).alias("_name"),
                                               F.regexp_extract("path", "/segment=([0-9]+)/", 1).cast("long").alias("_segment"))
        def plain(c):       # once for the path's own encoding, once for the folder's name
            return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
        known = files.groupBy(plain(plain(F.col("_name"))).alias("_known")).agg((F.max("_segment") + 1).alias("_next"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], "_known string, _next long")
    placed = ranked.join(known, F.col("_shard") == F.col("_known"), "left").withColumn(
        "segment", F.coalesce("_next", F.lit(0)) + F.floor((F.col("_rank") - 1) / segment_rows))
    last = placed.groupBy(F.col("_shard").alias("_s"), F.col("segment").alias("_g")).agg(F.max("_number").alias("last"))
    out = placed.join(last, (F.col("_shard") == F.col("_s")) & (F.col("segment") == F.col("_g")))
    (out.select(json_text(*[F.col(f"`{c}`") for c in df.columns]).alias("value"), F.col("_shard").alias("shard"), "_number",
                F.lpad(F.col("segment").cast("string"), 12, "0").alias("segment"), F.lpad(F.col("last").cast("string"), 20, "0").alias("last"))
     .repartition("shard", "segment").sortWithinPartitions("shard", "segment", "last", "_number").drop("_number")
     .write.mode("append").partitionBy("shard", "segment", "last").text(path))


class _Segments(InputPartition):
    def __init__(self, shard: str, files: list[tuple[int, str]]):
        self.shard, self.files = shard, files


class ShardReader(DataSourceStreamReader):
    """Offsets: shard -> next segment."""

    def __init__(self, options: Mapping[str, str]):
        self.path, self.start = options["path"], options.get("start", EARLIEST)
        self.known: dict[str, int] = {}         # next segment, as of the last listing

    def _folder(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path)

    @staticmethod
    def _names(store: pafs.FileSystem, folder: str, key: str) -> list[str]:
        found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(x.base_name.partition("=")[2] for x in found if x.base_name.startswith(f"{key}="))

    def _files(self, store: pafs.FileSystem, root: str, shard: str, segments: Sequence[int]) -> dict[int, pafs.FileInfo]:
        """The files of those segments that have one."""
        top, found = f"{root}/shard={shard}", {}
        for folder in [f"{top}/segment={n:012d}" for n in segments] if len(segments) <= FEW else [top]:
            for x in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True)):
                if x.is_file and not x.base_name.startswith((".", "_")):
                    number = re.search(r"/segment=(\d+)/last=[^/]*/[^/]*$", x.path)
                    if number:
                        found.setdefault(int(number[1]), []).append(x)
        for n in segments:
            if len(found.get(n, [])) > 1:
                raise ValueError(f"two writers wrote segment {n} of shard {unquote(shard)}: {[x.path for x in found[n]]}")
        return {n: found[n][0] for n in segments if n in found}

    def _advance(self) -> dict[str, int]:
        """Follow each shard's segments as far as they come without a gap."""
        store, root = self._folder()
        for shard in self._names(store, root, "shard"):
            if shard not in self.known:
                numbers = [int(x) for x in self._names(store, f"{root}/shard={shard}", "segment")]
                at = min(numbers, default=0)
                present = set(numbers)
                while at + 1 in present:
                    at += 1
                self.known[shard] = at
            while self._files(store, root, shard, [self.known[shard]]):
                self.known[shard] += 1
        return dict(self.known)

    def initialOffset(self) -> dict:
        """Called for a new checkpoint only."""
        if self.start == EARLIEST:
            return {}
        if self.start == LATEST:
            return self._advance()
        store, root = self._folder()
        first = {}
        for shard in self._names(store, root, "shard"):
            after = json.loads(self.start).get(unquote(shard))
            for segment in self._names(store, f"{root}/shard={shard}", "segment") if after is not None else ():
                last = self._names(store, f"{root}/shard={shard}/segment={segment}", "last")
                first[shard] = int(segment) + (bool(last) and int(last[0]) <= after)
                if last and int(last[0]) > after:
                    break
        return first

    def latestOffset(self) -> dict:
        return self._advance()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, root = self._folder()
        out = []
        for shard, until in end.items():
            if shard in start:
                numbers = range(start[shard], until)
            else:       # a shard of which nothing was read: from its first segment that is still there
                numbers = [n for n in map(int, self._names(store, f"{root}/shard={shard}", "segment")) if n < until]
            files = self._files(store, root, shard, numbers)
            size = SPLIT
            for n in numbers:
                if n not in files:
                    raise FileNotFoundError(f"segment {n} of shard {unquote(shard)} is gone from {self.path}")
                if size + files[n].size > SPLIT:
                    out.append(_Segments(shard, []))
                    size = 0
                out[-1].files.append((n, files[n].path))
                size += files[n].size
        return out

    def read(self, partition: _Segments) -> Iterator[pa.RecordBatch]:
        store, _ = self._folder()
        shard = unquote(partition.shard)
        rows = []       # (segment, line)

        def batch(part: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard] * len(part)), pa.array([n for n, _ in part], pa.int64()), pa.array([x for _, x in part])],
                                              ["shard", "segment", "value"])
        for segment, file in partition.files:
            with store.open_input_stream(file) as stream:     # compressed files by their suffix
                rest = b""
                while block := stream.read(1 << 20):
                    *whole, rest = (rest + block).split(b"\n")
                    rows += [(segment, x.decode("utf-8", "replace")) for x in whole if x]
                    while len(rows) >= LINES:
                        yield batch(rows[:LINES])
                        rows = rows[LINES:]
                if rest:
                    rows.append((segment, rest.decode("utf-8", "replace")))
        if rows:
            yield batch(rows)


class ShardLog(DataSource):
    """``shard, segment, value``: the raw lines of a log's segments."""

    @classmethod
    def name(cls) -> str:
        return "shard_log"

    def schema(self) -> str:
        return "shard string, segment long, value string"

    def streamReader(self, schema: StructType) -> ShardReader:
        return ShardReader(self.options)


def read_shards(spark: SparkSession, path: str, schema: str | StructType, start: str | Mapping[str, int] = EARLIEST,
                skip_bad: bool = True, sequence: str = "sequence_number", corrupt: str = "_corrupt_record") -> DataFrame:
    """The typed records of a log from ``start`` on: ``"earliest"``, ``"latest"`` or, by shard, the sequence
    number after which reading begins (shards that are not named are read whole).

    Lines that do not parse are dropped, or kept in ``corrupt`` with ``skip_bad=False``."""
    if not isinstance(start, str):
        start = {str(k): int(v) for k, v in start.items()}
    elif start not in (EARLIEST, LATEST):
        raise ValueError(f"start is {EARLIEST!r}, {LATEST!r} or a sequence number for each shard")
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])     # the process that plans a source has no shipped packages
    spark.dataSource.register(ShardLog)
    lines = (spark.readStream.format("shard_log").option("path", path)
             .option("start", start if isinstance(start, str) else json.dumps(start)).load())
    wide = StructType(st.fields + [StructField(corrupt, StringType())])
    rows = lines.select("shard", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r")).select("shard", "r.*")
    if isinstance(start, dict) and start:       # the segment that holds the position is read whole
        after = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])
        number = F.col(sequence).try_cast("long")
        rows = rows.where(F.get(F.array(after), F.lit(0))[F.col("shard")].isNull() | number.isNull() | (number > after[F.col("shard")]))
    rows = rows.drop("shard")
    return rows.where(F.col(corrupt).isNull()).drop(corrupt) if skip_bad else rows
