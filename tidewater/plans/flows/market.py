"""Market snapshots (P1): JSON array -> three normalised tables -> CSV landing
-> append by column name -> change capture with upsert -> latest-snapshot SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.operators.star import snapshot_split

# Raw snapshot fields.
RAW_FIELDS = ["id", "symbol", "name", "current_price", "market_cap", "total_volume", "high_24h", "low_24h",
              "price_change_percentage_24h", "circulating_supply", "ath", "ath_date", "last_updated"]


def transform(raw: DataFrame, extracted_at: str, asof: str) -> dict[str, DataFrame]:
    """M5 + I1-I8: clean and enrich the raw snapshot, then split it into
    ``coin_data``, ``market_data`` and ``price_data`` sharing ``(id, extracted_at)``.

    Absent or null numbers count as 0 before arithmetic (C10); ratios are null
    when the denominator is 0; instants are kept as UTC wall-clock timestamps.
    """
    text = {"id", "symbol", "name", "ath_date", "last_updated"}
    df = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string" if c in text else "double").alias(c) for c in RAW_FIELDS])
    z = {c: C.zero_if_null(c) for c in ["market_cap", "total_volume", "current_price", "ath", "high_24h", "low_24h"]}
    ath_date = C.parse_instant("ath_date")
    df = df.select(
        "id",
        F.upper(F.coalesce(F.col("symbol"), F.lit(""))).alias("symbol"),
        C.title_case(F.coalesce(F.col("name"), F.lit(""))).alias("name"),
        C.tier_strict(z["market_cap"]).alias("market_cap_tier"),
        z["market_cap"].cast("decimal(38,2)").alias("market_cap"),
        z["total_volume"].cast("decimal(38,2)").alias("total_volume"),
        F.col("circulating_supply").cast("decimal(38,2)").alias("circulating_supply"),
        C.safe_ratio(z["total_volume"], z["market_cap"], 6).alias("volume_to_mcap_ratio"),
        z["current_price"].alias("current_price"), z["high_24h"].alias("high_24h"), z["low_24h"].alias("low_24h"),
        z["ath"].alias("ath"),
        ath_date.cast("timestamp_ntz").alias("ath_date"),
        F.col("price_change_percentage_24h"),
        C.safe_ratio(z["current_price"], z["ath"], 4).alias("price_to_ath_ratio"),
        C.rounded_diff(z["high_24h"], z["low_24h"], 2).alias("daily_price_range"),
        C.days_since(ath_date, asof).alias("days_since_ath"),
        C.parse_instant("last_updated").cast("timestamp_ntz").alias("last_updated"),
        F.lit(extracted_at).cast("timestamp_ntz").alias("extracted_at"),
    )
    return snapshot_split(df, "id", "extracted_at", {
        "coin_data": ["symbol", "name", "market_cap_tier"],
        "market_data": ["market_cap", "total_volume", "circulating_supply", "volume_to_mcap_ratio"],
        "price_data": ["current_price", "high_24h", "low_24h", "ath", "ath_date", "price_change_percentage_24h",
                       "price_to_ath_ratio", "daily_price_range", "days_since_ath", "last_updated"],
    })


# Columns of the latest-snapshot report.
REPORT = ("id", "symbol", "name", "market_cap_tier", "market_cap", "current_price", "volume_to_mcap_ratio",
          "price_to_ath_ratio", "daily_price_range", "days_since_ath", "extracted_at")


def latest_prices(coin: DataFrame, market: DataFrame, price: DataFrame, n: int = 10) -> DataFrame:
    """D5 + G2: the latest snapshot joined across the three tables, the report's 11 columns, top
    ``n`` by market cap."""
    from tidewater.operators.relational import latest_snapshot_join, top_n
    j = latest_snapshot_join([coin, market, price])
    return top_n(j.select(*REPORT), [F.col("market_cap").desc(), F.col("id")], n)


LANDING_SCHEMAS = {
    "coin_data": "id string, symbol string, name string, market_cap_tier string, extracted_at timestamp_ntz",
    "market_data": ("id string, market_cap decimal(38,2), total_volume decimal(38,2), "
                    "circulating_supply decimal(38,2), volume_to_mcap_ratio double, extracted_at timestamp_ntz"),
    "price_data": ("id string, current_price double, high_24h double, low_24h double, ath double, "
                   "ath_date timestamp_ntz, price_change_percentage_24h double, price_to_ath_ratio double, "
                   "daily_price_range double, days_since_ath int, last_updated timestamp_ntz, "
                   "extracted_at timestamp_ntz"),
}


def run(spark, raw: DataFrame, out: str, extracted_at: str, asof: str) -> dict[str, DataFrame]:
    """One snapshot run: transform, land three CSVs (one folder each, stamped by
    the run), append them by column name (each file once), apply each table's new
    files to its current state through a change stream, and answer the
    latest-snapshot query."""
    from tidewater.operators import cdc
    from tidewater.sources import loads
    from tidewater.sources.writers import write_csv
    from tidewater.streaming.streams import run_available_now

    stamp = extracted_at.replace("-", "").replace(":", "").replace(" ", "T")
    tables = transform(raw, extracted_at, asof)
    current = {}
    for name, df in tables.items():
        write_csv(df, f"{out}/transformed/{name}/{stamp}", mode="errorifexists")
        loads.copy_into(spark, f"{out}/transformed/{name}", f"{out}/landing/{name}", LANDING_SCHEMAS[name],
                        f"{out}/load_history/{name}", asof)
        # the landing table's new files are the change stream: a run merges its own snapshot only
        schema = spark.read.parquet(f"{out}/landing/{name}").schema
        changes = spark.readStream.schema(schema).parquet(f"{out}/landing/{name}").drop(loads.LOAD_ID, "_file_path")
        handler = cdc.change_batch_handler(spark, f"{out}/current/{name}", "id", ["extracted_at"], buckets=8)
        run_available_now(changes, handler, f"{out}/_checkpoints/{name}")
        current[name] = cdc.current_state(spark, f"{out}/current/{name}")
    landed = {n: loads.read_landing(spark, f"{out}/landing/{n}") for n in tables}
    return {**landed, "current": current["coin_data"], **{f"current_{n}": c for n, c in current.items()},
            "latest": latest_prices(landed["coin_data"], landed["market_data"], landed["price_data"])}
