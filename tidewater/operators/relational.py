"""Joins, aggregates, ranks, shares, top-n and set operations.

Scale notes
-----------
* No broadcast hints on data of unknown size: file-backed sides are sized by the
  planner in bytes, derived ones by AQE at run time; beyond the threshold the join
  stays a sort-merge join with skew splitting.
* Per-key reductions use ``groupBy`` + ``max(struct(...))`` so partial
  aggregation shrinks every hot key before the shuffle; no group is ever
  collected into one task.
* Ranks never use an unpartitioned window or a window partitioned by a
  low-cardinality key: rows are range-partitioned on the full sort key (which the
  range partitioner splits evenly even when one group holds a third of the rows),
  numbered inside each partition and shifted by per-partition offsets that are
  computed on a table with one row per (partition, group).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.session import materialize


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


# ---------------------------------------------------------------- 2D joins
def left_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left equi join on one or several columns.

    A null in any key column finds no partner, so the dimension's columns are null.
    """
    return fact.join(dim, on=_cols(on), how="left")


def inner_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi join (one or several keys)."""
    return fact.join(dim, on=_cols(on), how="inner")


def _source(df: DataFrame, name: str) -> Column | None:
    """Column ``name`` of ``df``: a top-level column of that (maybe dotted) name, or a struct field."""
    if name in df.columns:
        return F.col("`" + name.replace("`", "``") + "`")
    root, _, rest = name.partition(".")
    if not rest or root not in df.columns or not isinstance(df.schema[root].dataType, StructType):
        return None
    return F.col(name) if rest in df.schema[root].dataType.fieldNames() else None


def lookup_left(fact: DataFrame, dim: DataFrame | None, fact_key: str, dim_key: str,
                values: Mapping[str, str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Enrich ``fact`` with ``values`` (dim column -> output name) looked up by key.

    The dimension's key is first read as the fact's key type (a key that cannot be
    read is dropped), then reduced to one row per key deterministically (smallest
    value tuple), so that no fact row is doubled.  The join is left; the planner
    sizes the reduced side.  Output nulls are filled with ``defaults``.  When the
    dimension is missing or lacks a needed column the fact passes through with
    the default values.
    """
    defaults = dict(defaults or {})
    out_names = list(values.values())
    sources = None if dim is None else {v: _source(dim, v) for v in [dim_key, *values]}
    if sources is None or any(c is None for c in sources.values()):
        return fact.select("*", *[F.lit(defaults.get(n)).alias(n) for n in out_names])
    key_type = fact.schema[fact_key].dataType
    reduced = (dim.select(sources[dim_key].try_cast(key_type).alias("_lk_key"), *[sources[s].alias(o) for s, o in values.items()])
               .where(F.col("_lk_key").isNotNull())
               .groupBy("_lk_key").agg(F.min(F.struct(*out_names)).alias("_lk"))
               .select("_lk_key", *[F.col(f"_lk.{o}").alias(o) for o in out_names]))
    joined = fact.join(reduced, F.col(fact_key) == F.col("_lk_key"), "left").drop("_lk_key")
    fills = {n: defaults[n] for n in out_names if n in defaults and defaults[n] is not None}
    return joined.fillna(fills) if fills else joined


def latest_snapshot_join(frames: Sequence[DataFrame], keys: Sequence[str] = ("id", "extracted_at"),
                         ts: str = "extracted_at") -> DataFrame:
    """Join snapshot tables on ``keys``, keeping only the latest snapshot of the first.

    The latest instant is read once (one value) and given to every frame as a
    literal filter, so partitions and row groups of the other histories are pruned.
    """
    latest = frames[0].agg(F.max(ts)).first()[0]
    kept = [fr.where(F.col(ts) == F.lit(latest)) for fr in frames]      # an empty history: null, no rows
    out = kept[0]
    for fr in kept[1:]:
        out = out.join(fr, on=list(keys), how="inner")
    return out


# ---------------------------------------------------------------- 2E aggregates
def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest ``order`` tuple.

    Ties on ``order`` are broken by the remaining columns, so the result is
    deterministic.  Implemented as ``max(struct)`` so the reduction is partial
    (map-side) before the shuffle: a hot key costs one row per map task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest]).alias("_row")
    return (df.groupBy(*keys).agg(F.max(packed).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c not in keys])
            .select(*df.columns))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (optionally of a projection)."""
    return (df.select(*cols) if cols else df).distinct()


def labelled_counts(frames: Mapping[str, DataFrame], label: str = "table_name",
                    count: str = "row_count") -> DataFrame:
    """``UNION ALL`` of one ``(label, count)`` row per frame."""
    out = None
    for name, fr in frames.items():
        row = fr.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count)
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- 2F ranks and shares
def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                name: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """1-based row number by ``order`` inside each ``group`` (none = global).

    ``order`` must end with a unique tie-break so results repeat between runs.
    Steps: range-partition on ``group + order`` and sort inside partitions; number
    the rows with ``monotonically_increasing_id`` (partition index in the high
    bits); materialize once (Parquet under the checkpoint location) so a lost
    executor cannot renumber; count rows per (partition, group); turn those counts
    into offsets with a window over that small table; join the offsets back (left
    to the planner).
    """
    spark = df.sparkSession
    group = list(group)
    # at least one range partition per core of the cluster (or the shuffle
    # partition count when that is larger)
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              spark.sparkContext.defaultParallelism)
    sort = [F.col(g).asc_nulls_first() for g in group] + _sort_cols(order)
    numbered = (df.repartitionByRange(n, *sort)
                .sortWithinPartitions(*sort)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright(F.col("_mid"), 33)))
    numbered = materialize(numbered, "rank")
    keys = [f"_g{i}" for i in range(len(group))]
    per = (numbered.groupBy(F.col("_pid").alias("_ppid"), *[F.col(g).alias(k) for g, k in zip(group, keys)])
           .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")))
    w = Window.partitionBy(*keys).orderBy("_ppid") if keys else Window.orderBy("_ppid")
    per = per.withColumn("_off", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    cond = F.col("_pid") == F.col("_ppid")
    for g, k in zip(group, keys):
        cond = cond & F.col(g).eqNullSafe(F.col(k))
    out = numbered.join(per, cond, "inner")
    rank = (F.col("_off") + (F.col("_mid") - F.col("_first")) + 1).cast("long")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], rank.alias(name))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """1-based rank over the whole frame, without a single-partition window."""
    return rank_within(df, [], order, name)


def share_pct(df: DataFrame, value: str, group: Sequence[str], name: str = "share_pct",
              digits: int = 2) -> DataFrame:
    """``value / sum(value) over group * 100``, rounded.

    The input is evaluated once (materialized); the group totals come from a
    partial aggregation and are joined back on the group key, so a hot group is
    never gathered into one window task.
    """
    df = materialize(df, "share")
    group = list(group)
    keys = [f"_g{i}" for i in range(len(group))]
    totals = (df.groupBy(*[F.col(g).alias(k) for g, k in zip(group, keys)])
              .agg(F.sum(value).alias("_group_total")))
    cond = None
    for g, k in zip(group, keys):
        c = F.col(g).eqNullSafe(F.col(k))
        cond = c if cond is None else cond & c
    joined = df.join(totals, cond, "left")
    share = F.round(F.try_divide(F.col(value).cast("double"), F.col("_group_total").cast("double")) * 100, digits)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], share.alias(name))


# ---------------------------------------------------------------- 2G sort / top-n
def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` (planned as TakeOrderedAndProject:
    each partition keeps its own top ``n``, then one merge of ``n * partitions`` rows)."""
    return df.orderBy(*_sort_cols(order)).limit(n)


def sort_by_number(df: DataFrame, text_col: str, descending: bool = True,
                   tie: Iterable[str] = ()) -> DataFrame:
    """Order by a text column read as a number (bad text sorts as null)."""
    key = F.col(text_col).try_cast("double")
    key = key.desc_nulls_last() if descending else key.asc_nulls_last()
    return df.orderBy(key, *[F.col(t) for t in tie])
