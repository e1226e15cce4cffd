"""Ride star schema (P3): refine -> 3 dimensions + fact -> models -> tests.

``run`` writes the dimensions and the date-partitioned fact as Parquet, then
builds the models over what was written (so the fact's keys are the keys on
disk, never a second evaluation of an id generator).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.operators import quality as Q
from tidewater.operators.relational import top_n
from tidewater.operators.star import build_dim, build_fact, hash_keys
from tidewater.session import materialize, scratch_scope

VENDOR_COLS = ["vendor_id"]
PAYMENT_COLS = ["payment_type"]
LOCATION_COLS = ["pickup_city", "pickup_location", "dropoff_city", "dropoff_location"]
GRAIN = ["vendor_key", "payment_key", "location_key", "trip_date"]


NATURAL = VENDOR_COLS + PAYMENT_COLS + LOCATION_COLS + ["trip_date"]


def grain(trips: DataFrame, checkpoint: bool = True) -> DataFrame:
    """Pre-aggregate the trips to the fact grain on natural keys, in one pass.

    Sums and counts (not averages) are kept so the fact can be re-aggregated
    exactly after the key swap.  The result has one row per (vendor, payment,
    route, day), far fewer than trips; it is checkpointed so the three
    dimensions and the fact all read it instead of re-running the trip joins
    (written as Parquet under the checkpoint location: the lineage is cut there).
    """
    df = trips.withColumn("trip_date", C.to_day("pickup_datetime"))
    g = df.groupBy(*NATURAL).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("trip_distance").alias("sum_distance"), F.count("trip_distance").alias("n_distance"),
        F.sum("fare_amount").alias("sum_fare"), F.count("fare_amount").alias("n_fare"),
        F.sum("tolls_amount").alias("total_tolls"),
    )
    return materialize(g, "ride-grain") if checkpoint else g


def dimensions(grain_df: DataFrame, method: str = "hash") -> dict[str, DataFrame]:
    """M1 / M2: the three dimensions of the ride star (from trips or their grain).

    The distinct natural-key combinations are computed once and materialized;
    each dimension is a distinct over that (much smaller) table.
    """
    keys = materialize(grain_df.select(*VENDOR_COLS, *PAYMENT_COLS, *LOCATION_COLS).distinct(), "ride-keys")
    return {
        "dim_vendor": build_dim(keys, VENDOR_COLS, "vendor_key", method),
        "dim_payment": build_dim(keys, PAYMENT_COLS, "payment_key", method),
        "dim_location": build_dim(keys, LOCATION_COLS, "location_key", method),
    }


def fact(grain_df: DataFrame, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """M3: swap natural keys for surrogate keys on the pre-aggregated grain and
    aggregate to the fact grain (null natural keys share the null surrogate).
    Without ``dims`` the keys are hashes and no join is needed."""
    keys = [(VENDOR_COLS, "vendor_key"), (PAYMENT_COLS, "payment_key"), (LOCATION_COLS, "location_key")]
    return build_fact(
        hash_keys(grain_df, keys) if dims is None else grain_df,
        [] if dims is None else [(dims["dim_" + key.removesuffix("_key")], cols, key) for cols, key in keys],
        GRAIN,
        {
            "total_trips": F.sum("total_trips"),
            "total_revenue": F.sum("total_revenue"),
            "avg_distance": F.sum("sum_distance") / F.sum("n_distance"),
            "avg_fare": F.sum("sum_fare") / F.sum("n_fare"),
            "total_tolls": F.sum("total_tolls"),
        },
    )


# ---------------------------------------------------------------- models
def total_revenue(facts: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """E5 + D4 + G1: revenue by vendor, highest first."""
    return (facts.join(dim_vendor, "vendor_key")
            .groupBy("vendor_id").agg(F.sum("total_revenue").alias("revenue"))
            .orderBy(F.col("revenue").desc()))


def revenue_by_payment(facts: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """E5: revenue by payment type, highest first."""
    return (facts.join(dim_payment, "payment_key")
            .groupBy("payment_type").agg(F.sum("total_revenue").alias("revenue"))
            .orderBy(F.col("revenue").desc()))


def daily_avg_fare(facts: DataFrame, weighted: bool = False) -> DataFrame:
    """Average of the stored per-group averages by date (unweighted, as the
    model states); ``weighted=True`` weights by ``total_trips`` instead."""
    if weighted:
        agg = (F.sum(F.col("avg_fare") * F.col("total_trips")) / F.sum("total_trips")).alias("avg_daily_fare")
    else:
        agg = F.avg("avg_fare").alias("avg_daily_fare")
    return facts.groupBy("trip_date").agg(agg).orderBy("trip_date")


def top_routes(facts: DataFrame, dim_location: DataFrame, n: int = 10) -> DataFrame:
    """E7 + G2: revenue and trips by route, top ``n`` by revenue (route names break ties)."""
    agg = (facts.join(dim_location, "location_key")
           .groupBy("pickup_location", "dropoff_location")
           .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_trips").alias("trips")))
    return top_n(agg, [F.col("revenue").desc(), F.col("pickup_location"), F.col("dropoff_location")], n)


def model_tests(facts: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """The star's generic and singular tests as one result table."""
    return Q.test_results({
        "not_null_dim_vendor_vendor_id": Q.not_null(dim_vendor, "vendor_id"),
        "unique_dim_vendor_vendor_key": Q.unique(dim_vendor, ["vendor_key"]),
        "not_null_dim_vendor_vendor_key": Q.not_null(dim_vendor, "vendor_key"),
        "relationships_facts_vendor_key": Q.relationships(facts, dim_vendor, "vendor_key", "vendor_key"),
        "no_negative_revenue": facts.where(F.col("total_revenue") < 0),
    })


# Raw trip columns, their new names, and raw columns that are dropped.
RENAMES = {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime", "VendorID": "vendor_id"}
DROPPED = ("store_and_fwd_flag",)


def refine(raw: DataFrame) -> DataFrame:
    """Refine step (C2, C3, I10): rename and drop raw columns, read numbers and instants from text (what
    does not read is null), derive the trip's day."""
    df = raw.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in raw.columns}).drop(*DROPPED)
    for c in ("trip_distance", "fare_amount", "tolls_amount", "total_amount"):
        df = df.withColumn(c, F.col(c).try_cast("double"))
    return df.withColumn("pickup_datetime", F.col("pickup_datetime").try_cast("timestamp")).withColumn("trip_date", C.to_day("pickup_datetime"))


def run(spark: SparkSession, trips: DataFrame, out: str, landing: bool = False) -> dict[str, DataFrame]:
    """Whole flow: (land the raw trips as CSV and read them back,) refine, write dims and fact, read them
    back, materialise the models.

    Keys are hashes of the natural keys and the fact table is replaced whole, so a
    run over other trips leaves nothing of the run before.
    """
    from tidewater.sources.readers import read_csv_by_name
    from tidewater.sources.writers import write_csv, write_parquet

    with scratch_scope(spark):
        if landing:
            schema = ", ".join(f"`{c}` string" for c in trips.columns)
            trips = read_csv_by_name(spark, write_csv(trips, f"{out}/raw", compression="gzip"), schema, "*.csv.gz")
        g = grain(refine(trips))
        for name, d in dimensions(g).items():
            write_parquet(d, f"{out}/{name}")
        dims = {name: spark.read.parquet(f"{out}/{name}") for name in ("dim_vendor", "dim_payment", "dim_location")}
        # rows of a day come together, so a day's folder gets few files
        write_parquet(fact(g).hint("rebalance", F.col("trip_date")), f"{out}/fact_trips", partition_by=["trip_date"])
    facts = spark.read.parquet(f"{out}/fact_trips")
    return {
        **dims,
        "facts": facts,
        "total_revenue": total_revenue(facts, dims["dim_vendor"]),
        "revenue_by_payment": revenue_by_payment(facts, dims["dim_payment"]),
        "daily_avg_fare": daily_avg_fare(facts),
        "top_routes": top_routes(facts, dims["dim_location"]),
    }
