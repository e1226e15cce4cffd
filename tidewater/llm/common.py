"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch.  Texts may be very long, so batches are kept short:
#: a Python worker then holds a few hundred texts at a time, whatever the table.
BATCH_ROWS = 512


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the Arrow batches of this session to ``rows`` rows, and let small shuffle partitions be
    joined up to the advisory size: the many small tables between the steps then have few files."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def col(name: str):
    """The column called exactly ``name`` (which may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain_names(df: DataFrame) -> DataFrame:
    """The columns of ``df`` by number (c0, c1, ...): names may hold dots or differ in nothing that Spark sees."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def with_schema_of(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` under the column names of ``like``."""
    return df.toDF(*like.columns)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null as empty); every other column is left out,
    so extra columns of any name cannot clash."""
    return df.select(col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; empty batches are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if isinstance(out, pa.Table):
                    yield from out.to_batches()
                elif out is not None:
                    yield out
    short_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, verdict: Callable[[pa.Array], object]) -> DataFrame:
    """Rows of ``df`` whose text passes ``verdict`` (a batch of texts to a boolean mask).

    All columns of the row travel through unchanged, so nothing is joined back:
    nulls, repeated rows and extra columns of any name are kept as they are.
    """
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(verdict(b.column(at)), pa.bool_()))
    short_batches(df.sparkSession)
    rows = plain_names(df)
    return with_schema_of(rows.mapInArrow(run, rows.schema), df)
