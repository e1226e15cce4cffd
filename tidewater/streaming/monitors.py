"""Per-batch monitors for a stream of window counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import columns as C

# Fixed value: the log-message pattern for a window count record.
COUNT_PATTERN = r'"window_end":\s*"([^"]+)",\s*"record_count":\s*(\d+)'


def log_rows(batch: DataFrame, payload: str = "data") -> DataFrame:
    """base64 payloads -> ``(timestamp ms, message)`` log rows; a payload
    that is not JSON is logged as ``{"raw": ...}``."""
    msg = C.decode_payload(payload)
    return batch.select((F.unix_millis(F.current_timestamp())).alias("timestamp"), msg.alias("message"))


def parse_count_logs(logs: DataFrame) -> DataFrame:
    """Log query: ``(window_end, record_count)`` parsed back out of the messages."""
    we, rc = C.parse_fields("message", COUNT_PATTERN, ["window_end", "record_count"])
    return logs.select(we, rc).select(F.col("window_end").try_cast("timestamp_ntz").alias("window_end"),
                                      F.col("record_count").try_cast("long").alias("record_count"))


def monitor_handler(spark: SparkSession, log_path: str, summary_path: str, payload: str = "data"):
    """``foreachBatch`` function writing the batch's log rows and one
    summary row ``(batch_id, received, status, summarised_at)``, keyed by batch id so a replay
    does not duplicate them; an empty batch still writes a heartbeat summary.

    The log rows are counted while they are written, so a batch costs the same however many came before."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        from tidewater.sources.writers import write_batch
        received = 0
        if not batch.isEmpty():
            seen = Observation()
            write_batch(log_rows(batch, payload).observe(seen, F.count(F.lit(1)).alias("received")), log_path, batch_id)
            received = seen.get["received"]
        row = spark.createDataFrame([(int(received), "ok" if received else "heartbeat")], "received long, status string")
        write_batch(row.withColumn("summarised_at", F.current_timestamp()), summary_path, batch_id)
    return handle


def window_record(counts: DataFrame, window_end: str, time_col: str = "window_end",
                  count_col: str = "record_count") -> DataFrame:
    """The record published for one window: its count, or ``(window_end, 0)`` when
    the trigger brought none."""
    end = F.lit(window_end).cast("timestamp_ntz")
    return counts.where(F.col(time_col).cast("timestamp_ntz") == end).agg(
        F.coalesce(F.sum(count_col), F.lit(0)).cast("long").alias(count_col)).select(end.alias(time_col), count_col)


def rows_per_shard(df: DataFrame, shard: str = "shard_id") -> DataFrame:
    """Rows per shard, to spot skew."""
    return df.groupBy(shard).agg(F.count(F.lit(1)).alias("rows"))


def landing_latency(df: DataFrame, event_ts: str, landed_ts: str) -> DataFrame:
    """Arrival-to-landing latency in seconds (per row) and its summary."""
    lat = (F.unix_micros(F.col(landed_ts).cast("timestamp")) - F.unix_micros(F.col(event_ts).cast("timestamp"))) / 1e6
    return df.select(lat.alias("latency_s")).agg(
        F.min("latency_s").alias("min_latency_s"), F.avg("latency_s").alias("avg_latency_s"),
        F.max("latency_s").alias("max_latency_s"))


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """J11 (batch): keys delivered more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
