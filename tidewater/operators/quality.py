"""Data-quality checks and the quality gate.

All statistics for one table come from a single distributed aggregation; the
check rows are then produced on the Spark side by exploding an array of structs
built from that one-row result, so nothing but the final verdict ever reaches
the driver.  Tables are always checked whole (L8: there is no row bound).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Gate thresholds.
MIN_ROW_COUNT = 10
MAX_NULL_PCT = 5.0
MAX_VALUE = 50_000_000_000
FRESHNESS_HOURS = 48
FRESHNESS_COLUMNS = ("_processed_at", "_ingestion_timestamp")

CHECK_SCHEMA = ("check string, table_name string, column_name string, value double, "
                "threshold double, passed boolean, message string")
CHECK_FIELDS = ["check", "table_name", "column_name", "value", "threshold", "passed", "message"]


def _row(check: str, table: str, column: str | Column | None, value: Column | None,
         threshold: float | None, passed: Column | bool, message: Column | str) -> Column:
    def lit(x, t):
        return x.cast(t) if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        lit(column, "string").alias("column_name"),
        lit(value, "double").alias("value"),
        lit(threshold, "double").alias("threshold"),
        lit(passed, "boolean").alias("passed"),
        lit(message, "string").alias("message"),
    )


def table_checks(df: DataFrame, table: str, critical: Sequence[str],
                 min_rows: int = MIN_ROW_COUNT, max_null_pct: float = MAX_NULL_PCT,
                 range_column: str | None = None, max_value: float = MAX_VALUE,
                 freshness_columns: Sequence[str] = FRESHNESS_COLUMNS,
                 *, asof: str, freshness_hours: int = FRESHNESS_HOURS) -> DataFrame:
    """L1-L5 (+L8) for one table, as check rows ``(check, table_name, column_name,
    value, threshold, passed, message)``."""
    cols = {c.lower(): c for c in df.columns}
    aggs = [F.count(F.lit(1)).alias("n")]
    present = [c for c in critical if c.lower() in cols]
    for i, c in enumerate(present):
        aggs.append(F.count_if(F.col(f"`{cols[c.lower()]}`").isNull()).alias(f"null{i}"))
    do_range = range_column is not None and range_column.lower() in cols
    if do_range:
        v = F.col(f"`{cols[range_column.lower()]}`")
        aggs += [F.count_if(v < 0).alias("neg"), F.count_if(v > F.lit(max_value)).alias("ext")]
    ts_col = next((cols[c.lower()] for c in freshness_columns if c.lower() in cols), None)
    if ts_col is not None:
        aggs.append(F.max(F.col(f"`{ts_col}`").cast("string").try_cast("timestamp")).alias("latest"))
    stats = df.agg(*aggs)

    n = F.col("n")
    rows = [_row("row_count", table, None, n, min_rows, n >= min_rows,
                 F.format_string("%d rows, at least %d wanted", n, F.lit(min_rows)))]
    for c in critical:
        if c in present:
            k = F.col(f"null{present.index(c)}")
            pct = F.when(n > 0, k * 100.0 / n).otherwise(F.lit(0.0))
            rows.append(_row("null_pct", table, c, F.round(pct, 2), max_null_pct, pct <= max_null_pct,
                             F.format_string(f"{c} is null in %.2f%% of rows, at most %.1f%% allowed", pct, F.lit(max_null_pct))))
        else:
            rows.append(_row("null_pct", table, c, None, max_null_pct, False,
                             f"no column {c}"))
    missing = sorted(set(c for c in critical if c.lower() not in cols))
    rows.append(_row("schema", table, None, F.lit(float(len(missing))), 0.0, not missing,
                     f"absent: {', '.join(missing)}" if missing else "every critical column is there"))
    if do_range:
        neg, ext = F.col("neg"), F.col("ext")
        rows.append(_row("value_range", table, range_column, neg + ext, max_value, (neg + ext) == 0,
                         F.format_string(f"{range_column} below 0 in %d rows, above %d in %d", neg,
                                         F.lit(int(max_value)), ext)))
    if ts_col is None:
        rows.append(_row("freshness", table, None, None, float(freshness_hours), True,
                         "no time column to judge by"))
    else:
        latest = F.col("latest")
        cutoff = F.lit(asof).cast("timestamp") - F.make_interval(hours=F.lit(freshness_hours))
        rows.append(_row("freshness", table, ts_col,
                         F.floor((F.unix_micros(cutoff) - F.unix_micros(latest)) / F.lit(3_600_000_000)),
                         float(freshness_hours),
                         F.when(latest.isNull(), True).otherwise(latest >= cutoff),
                         F.when(latest.isNull(), F.lit("no readable time"))
                         .otherwise(F.concat(F.lit("newest "), latest.cast("string"),
                                             F.lit(", due "), cutoff.cast("string")))))
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def read_failure(spark: SparkSession, table: str, error: str) -> DataFrame:
    """An unreadable table becomes one failed ``read_table`` check row."""
    return spark.createDataFrame([("read_table", table, None, None, None, False, error)], CHECK_SCHEMA)


def gate(spark: SparkSession, tables: Mapping[str, DataFrame | str], specs: Mapping[str, dict],
         *, asof: str) -> tuple[DataFrame, DataFrame]:
    """Run the checks of every table; an unreadable one, whether that shows when
    its path is resolved or only when its files are read, is a failed check and
    the others still run.  Returns ``(check_rows, summary_row)``."""
    parts = []
    for name, src in tables.items():
        spec = dict(specs.get(name, {}))
        spec.setdefault("critical", [])
        try:
            df = spark.read.parquet(src) if isinstance(src, str) else src
            rows = table_checks(df, name, asof=asof, **spec).collect()      # a few check rows; the table is read here
        except (PySparkException, Py4JJavaError) as e:      # the latter when a task fails while reading
            parts.append(read_failure(spark, name, str(e)))
            continue
        parts.append(spark.createDataFrame(rows, CHECK_SCHEMA))
    checks = parts[0]
    for p in parts[1:]:
        checks = checks.unionByName(p)
    return checks, summarise(checks)


def summarise(checks: DataFrame) -> DataFrame:
    """One row ``(quality_passed, checks_passed, checks_total)``; a check without a
    result has not passed."""
    passed = F.coalesce("passed", F.lit(False))
    return checks.agg(
        F.coalesce(F.bool_and(passed), F.lit(True)).alias("quality_passed"),
        F.count_if(passed).cast("int").alias("checks_passed"),
        F.count(F.lit(1)).cast("int").alias("checks_total"),
    )


def require_pass(summary: DataFrame) -> bool:
    """L6 routing: the next step runs only when the gate passed (one-row result)."""
    row = summary.first()
    if not row["quality_passed"]:
        raise RuntimeError(f"quality gate failed: {row['checks_passed']}/{row['checks_total']} checks passed")
    return True


# ---------------------------------------------------------------- model tests
def not_null(df: DataFrame, col: str) -> DataFrame:
    """Failing rows are those with a null ``col``."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Failing rows are key values that occur more than once (with their count)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence[object]) -> DataFrame:
    """Failing rows hold a non-null value outside ``values``."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def relationships(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose non-null key has no parent (left anti join)."""
    p = parent.select(F.col(parent_col).alias("_parent_key")).distinct()
    return (child.where(F.col(child_col).isNotNull())
            .join(p, F.col(child_col) == F.col("_parent_key"), "left_anti"))


def assert_empty(df: DataFrame) -> DataFrame:
    """A singular test is a query whose rows are its failures.  Raises on one, else
    returns the (empty) frame."""
    n = df.count()
    if n:
        raise AssertionError(f"{n} failing rows")
    return df


def test_results(tests: Mapping[str, DataFrame]) -> DataFrame:
    """``(test_name, failures, status)`` for a set of failing-row queries."""
    out = None
    for name, failing in tests.items():
        r = failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("test_name"), "failures",
            F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"))
        out = r if out is None else out.unionByName(r)
    return out
