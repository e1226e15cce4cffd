"""Batch readers: CSV (inferred, by header name, all-string
external), JSON (lines, arrays, glued objects, nested items), arrival-time
folders, Hive partitions, mixed formats and file listings.

Only one helper runs Python inside tasks, file by file and bounded by a file: the
splitter of glued JSON objects.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions import columns as C
from tidewater.operators.relational import rank_within
from tidewater.session import materialize

# ---------------------------------------------------------------- listings
def list_files(spark: SparkSession, path: str, suffix: str | None = None, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """``(path, length, modification_time)`` of the files whose names match ``glob`` (or end in
    ``suffix``), sorted by path.
    The binary-file source is used without its ``content`` column, so nothing but
    the listing is read."""
    r = spark.read.format("binaryFile")
    if glob or suffix:
        r = r.option("pathGlobFilter", glob or f"*{suffix}")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    # the path as the other readers report a row's file, so that listings can be joined to rows
    return (r.load(path).select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modification_time"))
            .orderBy("path"))


# ---------------------------------------------------------------- CSV
def read_csv(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """A1: header row + type inference."""
    return spark.read.option("header", True).option("inferSchema", infer).csv(path)


def read_csv_external(spark: SparkSession, path: str, cols: Sequence[str]) -> DataFrame:
    """A3: declared all-string table: comma separated, ``"`` quote, ``\\`` escape,
    header line skipped."""
    schema = StructType([StructField(c, StringType(), True) for c in cols])
    return (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", "\\")
            .csv(path))


def _csv_text(spark: SparkSession, path: str, glob: str, not_before) -> DataFrameReader:
    r = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if not_before is not None:      # a listing filter of Spark's; cells are read as text, so the zone serves it alone
        r = r.option("modifiedAfter", not_before).option("timeZone", "UTC")
    return r


#: A CSV record whose last quoted cell does not close: whole cells and their commas, then a quote with no end.
OPEN_QUOTE = r'(?s)^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^",][^,]*+|"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
_RAW = "_raw"


def _csv_records(spark: SparkSession, path: str, glob: str, not_before, multi_line: bool) -> DataFrame:
    """``(path, at, n, record)``: every record's own text, in the order of its file by ``n`` within a block
    that begins at ``at``.

    A record is a line, or, with ``multi_line``, what Spark's CSV parser takes as one: read into a
    single column, all others are "corrupt" and keep their text."""
    r = _csv_text(spark, path, glob, not_before)
    if multi_line:
        lines = (r.schema(f"_c0 string, {_RAW} string").option("columnNameOfCorruptRecord", _RAW).option("multiLine", True)
                 .option("escape", '"').csv(path).withColumn("value", F.coalesce(_RAW, "_c0")))
    else:
        lines = r.text(path)
    return lines.select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"))


def csv_headers(spark: SparkSession, path: str, glob: str = "*.csv", not_before=None, multi_line: bool = False) -> DataFrame:
    """``(path, names)`` for every CSV file under ``path``: its first record that is not blank, cut into
    cells by Spark's CSV parser, as lower-cased trimmed names.

    The header is the earliest record of a file's first block; records of a block keep
    their order inside a task, and the minimum is taken map-side.  Spark opens the
    files, so whatever it can read works.

    The same pass looks for records that end inside an open quote.  Read line by line, such a record
    goes on in the next line, so the files are refused; read with ``multi_line``, the quote
    swallowed the rest of its file, and they are refused as well."""
    text = F.col("record")
    odd = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    heads = materialize(
        _csv_records(spark, path, glob, not_before, multi_line).where(F.trim(text) != "").groupBy("path")
        .agg(F.min_by(F.when(F.col("at") == 0, text), F.when(F.col("at") == 0, F.col("n"))).alias("header"),
             F.count_if(F.when(odd, text.rlike(OPEN_QUOTE)).otherwise(F.lit(False))).alias("open")), "csv-records")
    torn, which, commas = heads.agg(F.sum("open"), F.min(F.when(F.col("open") > 0, F.col("path"))),
                                    F.max(F.length("header") - F.length(F.replace("header", F.lit(","), F.lit(""))))).first()
    if torn:
        how = "its quote is never closed" if multi_line else "read them with multi_line, if a cell may hold line breaks"
        raise ValueError(f"{torn} CSV record(s) end inside a quoted cell, the first in {which}: {how}")
    wide = ", ".join(f"c{i} string" for i in range((commas or 0) + 1))      # at least as many cells as any header has
    cells = F.from_csv(F.regexp_replace("header", "^\ufeff", ""), wide, {
        "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "multiLine": "true"})
    names = F.transform(F.array(*[cells[f"c{i}"] for i in range((commas or 0) + 1)]), lambda x: F.lower(F.trim(x)))
    return heads.where(F.col("header").isNotNull()).select("path", names.alias("names"))


def read_csv_by_name(spark: SparkSession, path: str, schema: str | StructType, glob: str = "*.csv",
                     files: DataFrame | None = None, keep_file: str | None = None, not_before=None,
                     multi_line: bool = False) -> DataFrame:
    """A2: load CSV files whose columns come in any order and case.

    Rows are read by position (Spark skips each file's own header line), and each
    field of ``schema`` is taken from the place where the file's header names it (the
    first, if it does so twice), typed with ``try_cast``; absent columns are null.  Files share few
    layouts: with one, the places are literals; with several, a row's file finds its layout by a
    join that the planner sizes.  No list of paths reaches the driver.

    ``files`` (a frame with a ``path`` column) restricts the files; ``keep_file``
    names a column for a row's file; ``not_before`` (a UTC time, as text) leaves out files
    that are not younger.  Quoted cells may hold commas and quotes; with ``multi_line`` also line
    breaks, at the price that a file is then one task's work.  Without it such files are refused.
    """
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    heads = csv_headers(spark, path, glob, not_before, multi_line)
    if files is not None:
        heads = heads.join(files.select("path"), "path", "left_semi")
    last = F.array_max(F.transform("names", lambda x, i: F.when(x.isNotNull(), i + 1)))
    heads = materialize(heads.select("path", F.coalesce(last, F.lit(1)).alias("width"), F.array(*[
        F.array_position("names", F.lit(f.name.lower())).cast("int") for f in st.fields]).alias("places")), "csv-headers")
    layouts = heads.select("places").distinct().limit(2).collect()
    width = heads.agg(F.max("width")).first()[0]
    if not layouts:
        empty = StructType(st.fields + ([StructField(keep_file, StringType())] if keep_file else []))
        return spark.createDataFrame([], empty)
    raw = (_csv_text(spark, path, glob, not_before).schema(", ".join(f"_c{i} string" for i in range(width)))
           .option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
           .select("*", F.col("_metadata.file_path").alias("path")))
    if len(layouts) > 1 or files is not None:
        raw = raw.join(heads.select("path", "places"), "path")
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
    out = []
    for i, f in enumerate(st.fields):
        if len(layouts) == 1:
            at = layouts[0]["places"][i]
            cell = F.col(f"_c{at - 1}") if at else F.lit(None).cast("string")
        else:
            at = F.col("places")[i]
            cell = F.when(at > 0, F.get(cells, at - 1))
        out.append(cell.try_cast(f.dataType).alias(f.name))
    return raw.select(*out, *([F.col("path").alias(keep_file)] if keep_file else []))


def read_csv_prefix(spark: SparkSession, prefix: str, fields: Sequence[str], missing: str = "", multi_line: bool = False) -> DataFrame:
    """A4: all CSV files under a prefix, a fixed field list (absent or empty -> ``missing``), each
    file read by its own header, with its path in ``_source_file``.

    Files are read in the sorted order of their paths by whoever orders by
    ``_source_file``; a frame itself has no order."""
    st = StructType([StructField(f, StringType(), True) for f in fields])
    df = read_csv_by_name(spark, prefix, st, keep_file="_source_file", multi_line=multi_line)
    return df.select(*[F.coalesce(F.col(f"`{f}`"), F.lit(missing)).alias(f) for f in fields], "_source_file")


# ---------------------------------------------------------------- JSON
def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A5: newline-delimited JSON with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """One JSON array document per file; each element becomes a row."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


#: Records and characters of one Arrow batch of split objects.
SPLIT_RECORDS, SPLIT_CHARS = 5_000, 1 << 20


def _split_glued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Executor side: split ``{..}{..}`` text into one JSON text per object.
    ``raw_decode`` respects strings, so ``}{`` inside a value is not a boundary;
    text that does not decode is kept as one bad record.  One file's text is decoded at a
    time and its objects leave in small batches, so memory does not grow with a task's files."""
    dec = json.JSONDecoder()
    for batch in batches:
        for p, value in zip(batch.column(0), batch.column(1)):
            docs, good, size = [], [], 0
            text, path = value.as_py(), p.as_py()

            def split() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([path] * len(docs), pa.string()), pa.array(docs, pa.string()), pa.array(good, pa.bool_())],
                                                  ["path", "doc", "good"])
            i, n = 0, len(text)
            while i < n:
                while i < n and text[i] in " \t\r\n,":
                    i += 1
                if i >= n:
                    break
                try:
                    _, j = dec.raw_decode(text, i)
                    good.append(True)
                except ValueError:
                    nxt = text.find("{", i + 1)
                    j = n if nxt < 0 else nxt
                    good.append(False)
                docs.append(text[i:j])
                size += j - i
                i = j
                if len(docs) >= SPLIT_RECORDS or size >= SPLIT_CHARS:
                    yield split()
                    docs, good, size = [], [], 0
            if docs:
                yield split()


def read_json_concat(spark: SparkSession, path: str, schema: str | StructType, skip_bad: bool = True,
                     corrupt: str = "_corrupt_record") -> DataFrame:
    """Files of JSON objects glued together without separators.

    Each file (bounded by the delivery flush size) is one ``wholetext`` row; the
    splitter runs file by file inside tasks and the objects are typed by Spark's
    ``from_json``.  ``spark.read.json`` would keep only the first object.  A piece
    that is no object is dropped, or with ``skip_bad=False`` kept as a row whose
    ``corrupt`` column holds its text.
    """
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    docs = raw.mapInArrow(_split_glued, "path string, doc string, good boolean")
    typed = F.from_json("doc", schema)
    good = F.col("good") & F.startswith("doc", F.lit("{")) & typed.isNotNull()
    if skip_bad:
        return docs.where(good).select(typed.alias("r"), "path").select("r.*", F.col("path").alias("_source_file"))
    return docs.select(F.when(good, typed).alias("r"), F.when(~good, F.col("doc")).alias(corrupt), "path") \
        .select("r.*", corrupt, F.col("path").alias("_source_file"))


def explode_items(df: DataFrame, items: str = "items", keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of the ``items`` array, flattened with ``_``;
    documents whose array is empty or missing yield no rows."""
    return C.flatten_struct(df.select(*keep, F.explode(items).alias("_item")).select(*keep, "_item.*"))


# Envelope fields.
ENVELOPE = ("ingestion_id", "region", "ingestion_timestamp", "video_count", "source")


def with_envelope(items: DataFrame, group: Sequence[str], ingestion_id: str, region: Column | str,
                  source: str, ts: str, order: Column | str, page_size: int = 50) -> DataFrame:
    """Wrap rows into ``{items: [...], _pipeline_metadata: {...}}`` documents of at most
    ``page_size`` items, with the item count and the ``region/date/hour`` layout columns.

    Rows are numbered within ``group`` by ``order`` (which has to be unique in it)
    without bringing a group together, and cut into pages; only a page is collected.
    """
    reg = F.col(region) if isinstance(region, str) else region
    body = [c for c in items.columns if c not in group]
    numbered = rank_within(items.withColumn("_region", reg), group, [order], "_n")
    paged = numbered.withColumn("_page", F.floor((F.col("_n") - 1) / page_size))
    g = paged.groupBy(*group, "_page").agg(F.collect_list(F.struct(*body)).alias("items"), F.first("_region").alias("_region"))
    tsc = F.lit(ts).cast("timestamp")
    values = (F.lit(ingestion_id), F.col("_region"), F.date_format(tsc, "yyyy-MM-dd HH:mm:ss"), F.size("items"), F.lit(source))
    return g.select(
        "items", F.struct(*[v.alias(n) for n, v in zip(ENVELOPE, values)]).alias("_pipeline_metadata"),
        F.col("_region").alias("region"), F.date_format(tsc, "yyyy-MM-dd").alias("date"),
        F.date_format(tsc, "HH").alias("hour"), *group)


# ---------------------------------------------------------------- folder layouts
# bare ``2024/01/02/03/`` folders, or the same written by Spark as ``year=2024/month=01/...``
ARRIVAL_RE = r"/(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/(?:hour=)?(\d{2})/[^/]+$"


def read_arrival_tree(spark: SparkSession, path: str, schema: str | StructType, fmt: str = "json") -> DataFrame:
    """Recursive read of ``YYYY/MM/DD/HH/`` folders; the folders become columns."""
    df = spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true").load(path)
    fp = F.col("_metadata.file_path")
    return df.select("*", *[F.regexp_extract(fp, ARRIVAL_RE, i).alias(n)
                            for i, n in enumerate(["year", "month", "day", "hour"], start=1)])


def read_partitioned(spark: SparkSession, path: str, predicate: Column | str | None = None) -> DataFrame:
    """Hive-style partitions; a predicate on partition columns prunes folders
    (``PartitionFilters`` in the plan) before any file is opened."""
    df = spark.read.parquet(path)
    return df.where(predicate) if predicate is not None else df


#: Parquet aggregates answered from footers: the setting, and sources that are not read by the newer API which does so.
_FOOTERS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


def filled_columns(spark: SparkSession, path: str) -> list[str]:
    """C6 for a written Parquet folder: the columns that are not null in every row, in their order.

    The counts come from the files' footers, so no row is read; only where files differ in
    their columns (or a column is nested) are the columns themselves counted."""
    def counts() -> dict:
        df = spark.read.option("mergeSchema", True).parquet(path)
        row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
        return {c: row[f"c{i}"] for i, c in enumerate(df.columns)}
    before = {k: spark.conf.get(k) for k in _FOOTERS}
    try:
        for k, v in _FOOTERS.items():
            spark.conf.set(k, v)
        found = counts()
    except Py4JJavaError:       # a file without one of the columns has no count of it
        found = None
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return [c for c, n in (found or counts()).items() if n]


def read_mixed(spark: SparkSession, path: str, mapping: Sequence[tuple[str, str, str, str]],
               csv_glob: str = "*.csv", json_glob: str = "*.json", multi_line: bool = False) -> DataFrame:
    """A10: one table from CSV rows and JSON rows under one prefix (C4 mapping on each)."""
    # each CSV file by its own header; the sources that the mapping names, as text
    names = StructType([StructField(m[0], StringType(), True) for m in mapping])
    csv = read_csv_by_name(spark, path, names, csv_glob, multi_line=multi_line)
    js = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", json_glob).json(path)
    return C.apply_mapping(csv, mapping).unionByName(C.apply_mapping(js, mapping), allowMissingColumns=True)


def read_table(spark: SparkSession, name_or_path: str, tables: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table, a logical source name (via ``tables``) or a Parquet path."""
    if tables and name_or_path in tables:
        name_or_path = tables[name_or_path]
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
