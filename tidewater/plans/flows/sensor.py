"""Sensor stream (P2): one file stream, three independent consumers with their
own checkpoints (raw archive, enrichment, 1-minute counts), then the per-batch
monitor over the counts and the log queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources import writers as W
from tidewater.streaming import monitors as MON
from tidewater.streaming import streams as ST


def run(spark: SparkSession, inbox: str, out: str, width: str = "1 minute",
        lateness: str = "5 seconds") -> dict[str, DataFrame]:
    """Process everything in ``inbox`` once (rerunning only picks up new files)."""
    src = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA)
    # consumer 1: raw archive in arrival-time folders, bad records to an error prefix
    raw = ST.read_stream_json(spark, inbox, ST.SENSOR_SCHEMA, skip_bad=False)

    def archive(batch, batch_id):
        good = batch.where(F.col(ST.CORRUPT).isNull()).drop(ST.CORRUPT)
        W.write_batch(ST.archive_layout(good), f"{out}/archive", batch_id, ["year", "month", "day", "hour"],
                      "json", **W.JSON_OPTIONS)
        W.write_batch(batch.where(F.col(ST.CORRUPT).isNotNull()).select(ST.CORRUPT), f"{out}/archive_errors",
                      batch_id, fmt="json")
    ST.run_available_now(raw, archive, f"{out}/_checkpoints/archive")
    # consumer 2: enrichment to a rolling JSON sink
    ST.run_available_now(ST.enrich(src), f"{out}/enriched", f"{out}/_checkpoints/enriched", fmt="json",
                         max_records_per_file=100_000)
    # consumer 3: window counts, emitted once per closed window
    ST.run_available_now(ST.tumbling_count(src, "processing_time", width, lateness), f"{out}/counts",
                         f"{out}/_checkpoints/counts")
    # monitor: the counts sink is a stream itself (its commit log tells which files are new), so a
    # window is logged once, however often the flow runs
    counts = spark.read.parquet(f"{out}/counts")
    stream = spark.readStream.schema(counts.schema).parquet(f"{out}/counts")
    body = F.to_json(F.struct(F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
                              "record_count"))
    messages = stream.select(F.base64(F.encode(body, "UTF-8")).alias("data"))
    ST.run_available_now(messages, MON.monitor_handler(spark, f"{out}/logs", f"{out}/log_summary"),
                         f"{out}/_checkpoints/monitor")
    logs = spark.read.parquet(f"{out}/logs")
    parsed = MON.parse_count_logs(logs)
    return {
        "archive": spark.read.json(f"{out}/archive"),
        "enriched": spark.read.json(f"{out}/enriched"),
        "counts": counts,
        "logs": logs,
        "log_view": parsed.orderBy(F.col("window_end").desc()).limit(20),
        "count_stats_5m": parsed.groupBy(F.window("window_end", "5 minutes").start.alias("bin")).agg(
            F.max("record_count").alias("max_rc"), F.min("record_count").alias("min_rc"),
            F.avg("record_count").alias("avg_rc")),
    }
