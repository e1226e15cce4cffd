"""Catalog helpers: external tables over written folders, crawling a
root into one table per folder, declared external CSV/JSON tables, typed landing
tables, named models and a load history.  Everything is Spark SQL DDL against
the session catalog; dropping an external table keeps its files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` with its folder under the shared
    checkpoint location (not the session's local warehouse folder)."""
    if location is None:
        from tidewater.session import scratch_dir
        location = scratch_dir(spark, f"warehouse-{db}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")


def register_table(spark: SparkSession, path: str, db: str, name: str, fmt: str = "parquet",
                   partition_by: tuple[str, ...] = (), options: Mapping[str, str] | None = None,
                   columns: StructType | None = None) -> str:
    """Create the database, drop and re-create the external table over
    ``path`` and recover its partitions.  Returns the qualified name.

    Spark infers columns and partitions itself: of Parquet from the footers of all files (read by its
    tasks), of JSON from all records.  ``partition_by`` is only checked against what it found, unless
    ``columns`` declares the table's columns."""
    create_database(spark, db)
    spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
    _create(spark, path, f"`{db}`.`{name}`", fmt, options, columns, partition_by)
    found = tuple(c.name for c in spark.catalog.listColumns(f"`{db}`.`{name}`") if c.isPartition)
    if partition_by and found != tuple(partition_by):
        raise ValueError(f"{path} is partitioned by {found}, not by {tuple(partition_by)}")
    return f"{db}.{name}"


def _create(spark: SparkSession, path: str, table: str, fmt: str, options: Mapping[str, str] | None = None,
            columns: StructType | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """An external table of the columns that all its files have together (or of those declared)."""
    given = {**({"mergeSchema": "true"} if fmt == "parquet" else {}), **(options or {})}
    opts = f"OPTIONS ({', '.join(f"'{k}' '{v}'" for k, v in given.items())})" if given else ""
    ddl = f"({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns.fields)})" if columns else ""
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if columns and partition_by else ""
    spark.sql(f"CREATE TABLE {table} {ddl} USING {fmt} {opts} {parts} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {table}")


def _columns(spark: SparkSession, table: str) -> list[tuple[str, str, bool]]:
    """Names and types, whatever their order."""
    return sorted((c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table))


def create_external(spark: SparkSession, name: str, columns: str, path: str, fmt: str = "csv",
                    options: Mapping[str, str] | None = None) -> str:
    """Declared external table (``CREATE TABLE ... USING csv/json OPTIONS ... LOCATION``)."""
    opts = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {f'OPTIONS ({opts})' if opts else ''} LOCATION '{path}'")
    return name


def create_landing(spark: SparkSession, name: str, columns: str, path: str, like: str | None = None) -> str:
    """Typed landing table (Parquet), or ``CREATE TABLE ... LIKE`` an existing one."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if like:
        spark.sql(f"CREATE TABLE {name} LIKE {like} USING parquet LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    return name


def catalog_path(spark: SparkSession, root: str, db: str) -> DataFrame:
    """One table per child folder of ``root``, of the columns that all its files have together.

    Returns ``(table_name, location, format, status, changes)`` rows.  A folder that is new is
    ``registered``; one whose columns or partition columns differ from the registered table's is
    ``updated``, with the differences; of others only the partitions are recovered (``unchanged``).
    Tables registered before whose folder is gone are marked ``deprecated=true``.  A folder that
    mixes formats, or CSV files of different headers, is rejected, and a table of it stays as it was.
    """
    from tidewater.sources.readers import csv_headers, list_files

    files = list_files(spark, root).select("path")
    at = "/" + root.rstrip("/").replace("file:", "").lstrip("/") if "://" not in root or root.startswith("file:") else root.rstrip("/")
    rel = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + re.escape(at) + "/", "")
    listing = (files.select(F.split(rel, "/").getItem(0).alias("folder"),
                            F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("ext"))
               .where(~F.col("ext").isin("crc", "") & ~F.col("folder").startswith("_")
                      & ~F.col("folder").startswith("."))
               .groupBy("folder").agg(F.sort_array(F.collect_set("ext")).alias("exts")).collect())      # a row for each folder
    create_database(spark, db)
    known = {t.name for t in spark.catalog.listTables(db) if t.tableType == "EXTERNAL"}
    rows, seen = [], set()
    for r in sorted(listing, key=lambda x: x["folder"]):
        name, loc, exts = r["folder"], f"{root.rstrip('/')}/{r['folder']}", list(r["exts"])
        seen.add(name)
        fmt = exts[0] if len(exts) == 1 and exts[0] in ("parquet", "json", "csv") else None
        if fmt is None:
            rows.append((name, loc, ",".join(exts), "rejected: mixed formats" if len(exts) != 1 else "rejected: unknown format", None))
            continue
        options = {}
        if fmt == "csv":
            if csv_headers(spark, loc).select("names").distinct().limit(2).count() > 1:
                rows.append((name, loc, fmt, "rejected: files of different headers", None))
                continue
            options = {"header": "true", "inferSchema": "true"}
        status, changes = _register(spark, loc, db, name, fmt, options, name in known)
        rows.append((name, loc, fmt, status, changes))
    for name in sorted(known - seen):
        spark.sql(f"ALTER TABLE `{db}`.`{name}` SET TBLPROPERTIES ('deprecated' = 'true')")
        rows.append((name, None, None, "deprecated", None))
    return spark.createDataFrame(rows, "table_name string, location string, format string, status string, changes string")


def _register(spark: SparkSession, loc: str, db: str, name: str, fmt: str, options: Mapping[str, str], known: bool) -> tuple[str, str | None]:
    """Register a folder, or bring its table up to date; returns the status and what changed."""
    table = f"`{db}`.`{name}`"
    if not known:
        _create(spark, loc, table, fmt, options)
        return "registered", None
    # what a table over the folder would be now, beside the one that is registered
    probe = f"`{db}`.`_probe_{uuid.uuid4().hex[:8]}`"
    _create(spark, loc, probe, fmt, options)
    try:
        before, now = _columns(spark, table), _columns(spark, probe)
    finally:
        spark.sql(f"DROP TABLE {probe}")
    if before == now:
        if any(part for _, _, part in now):
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('deprecated')")
        spark.catalog.refreshTable(table)
        return "unchanged", None
    spark.sql(f"DROP TABLE {table}")
    _create(spark, loc, table, fmt, options)
    show = lambda c: f"{c[0]} {c[1]}{' (partition)' if c[2] else ''}"
    changes = [f"+ {show(c)}" for c in now if c not in before] + [f"- {show(c)}" for c in before if c not in now]
    return "updated", "; ".join(changes)


class Models:
    """Models materialised by name; ``ref(name)`` resolves a logical source or
    another model.  Models may be declared in any order: one that refers to another
    builds it first, and a circle is refused."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame | str]):
        self.spark = spark
        self.sources = dict(sources)
        self.declared: dict[str, tuple] = {}
        self.built: dict[str, DataFrame] = {}
        self.building: list[str] = []

    def declare(self, name: str, build: Callable[["Models"], DataFrame], as_: str = "view", path: str | None = None) -> None:
        if as_ == "table" and path is None:
            raise ValueError("a table model needs a path")
        self.declared[name] = build, as_, path

    def ref(self, name: str) -> DataFrame:
        if name in self.built:
            return self.built[name]
        if name in self.declared:
            return self._build(name)
        src = self.sources[name]
        return self.spark.read.parquet(src) if isinstance(src, str) else src

    def _build(self, name: str) -> DataFrame:
        if name in self.building:
            raise ValueError("models refer to each other in a circle: " + " -> ".join([*self.building, name]))
        build, as_, path = self.declared[name]
        self.building.append(name)
        try:
            df = build(self)
        finally:
            self.building.pop()
        if as_ == "table":
            df.write.mode("overwrite").parquet(path)
            df = self.spark.read.parquet(path)
        df.createOrReplaceTempView(name)
        self.built[name] = df
        return df

    def run(self) -> dict[str, DataFrame]:
        """Build every declared model, each after those it refers to."""
        return {name: self.ref(name) for name in self.declared}

    def materialize(self, name: str, build: Callable[["Models"], DataFrame], as_: str = "view",
                    path: str | None = None) -> DataFrame:
        self.declare(name, build, as_, path)
        return self.ref(name)
