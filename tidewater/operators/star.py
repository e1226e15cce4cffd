"""Dimensional modelling: dimensions with surrogate keys, facts,
static code tables and the three-way snapshot split.

Surrogate keys are deterministic.  ``monotonically_increasing_id`` recomputed
after a shuffle need not give the keys that were written, so it is never used
for keys.  Two methods:

* ``hash``  ``xxhash64`` of the natural key columns: a key never moves when other
  natural keys come or go, so facts written earlier keep their meaning, and a fact
  finds its keys without a join; a collision fails loudly instead of merging two
  natural keys;
* ``rank``  dense 1-based rank of the natural key, comparable with SQL
  ``dense_rank``, by range-partitioned numbering
  (:func:`tidewater.operators.relational.rank_within`).  It moves when a smaller
  key arrives: dimensions and facts have to be rebuilt together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.relational import rank_within

def build_dim(df: DataFrame, cols: Sequence[str], key: str, method: str = "rank") -> DataFrame:
    """M1 / M2: distinct natural keys ``cols`` plus a 64-bit surrogate ``key``."""
    cols = list(cols)
    if method == "hash":
        # one aggregation finds the distinct natural keys and proves that no two share a hash
        row = F.struct(*cols)
        dim = df.select(*cols, F.xxhash64(*cols).alias(key)).groupBy(key).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
        same = F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(
            F.raise_error(F.lit(f"surrogate key collision in {key}")))
        return dim.select(same.alias("_row"), key).select("_row.*", key)
    nat = df.select(*cols).distinct()
    order = [F.col(c).asc_nulls_first() for c in cols]
    return rank_within(nat, [], order, key).select(*cols, key)


def swap_keys(df: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """M3 first half: left-join each dimension on its natural columns and keep
    its surrogate key.  A null natural key finds no match and gives a null key."""
    out = df
    for dim, cols, key in dims:
        d = dim.select(*cols, key)
        cond = None
        for c in cols:
            e = out[c] == d[c]
            cond = e if cond is None else cond & e
        out = out.join(d, cond, "left").drop(*[d[c] for c in cols])
    return out


def hash_keys(df: DataFrame, dims: Sequence[tuple[Sequence[str], str]]) -> DataFrame:
    """M3 first half for hash keys: a natural key's surrogate is computed where the row is.  As with a
    join, a null in any natural column gives a null key."""
    for cols, key in dims:
        known = F.lit(True)
        for c in cols:
            known = known & F.col(c).isNotNull()
        df = df.withColumn(key, F.when(known, F.xxhash64(*cols)))
    return df


def build_fact(df: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], str]],
               grain: Sequence[str], measures: Mapping[str, object]) -> DataFrame:
    """M3: swap natural keys for surrogate keys, then aggregate to ``grain``.

    ``measures`` maps output name -> aggregate Column.
    """
    keyed = swap_keys(df, dims)
    return keyed.groupBy(*grain).agg(*[c.alias(n) for n, c in measures.items()])


def static_dimension(spark: SparkSession, codes: Mapping[object, str], code_col: str,
                     label_col: str, code_type: str = "int") -> DataFrame:
    """M4: a code -> label table from literal values (a few rows; broadcast-safe)."""
    rows = [(k, v) for k, v in codes.items()]
    return spark.createDataFrame(rows, f"{code_col} {code_type}, {label_col} string")


# Static code tables of the ride star schema.
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
PAYMENT_TYPES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
VENDORS = {
    1: "Creative Mobile Technologies",
    2: "VeriFone",
}


def snapshot_split(df: DataFrame, key: str, ts: str, tables: Mapping[str, Sequence[object]]) -> dict[str, DataFrame]:
    """M5: split one snapshot frame into several tables sharing ``(key, ts)``.

    Each output is a projection of the same source; column pruning means each
    table reads only its own columns, so nothing is cached.
    """
    out = {}
    for name, cols in tables.items():
        out[name] = df.select(F.col(key), *[F.col(c) if isinstance(c, str) else c for c in cols], F.col(ts))
    return out
