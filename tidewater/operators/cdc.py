"""Change data capture: staging files -> change stream -> upsert.

``MERGE INTO`` needs a transactional table format; on plain Parquet the target is laid
out in hash buckets of the key (``_bucket = pmod(xxhash64(key), N)``).  A merge writes the
buckets that its changes touch into a new folder, and then one small manifest that
says for every bucket in which folder it now lies:

* changes are reduced to the latest row per key first (several snapshots of one
  key in one batch are the normal case), as a partial aggregation;
* the touched buckets of the target are read (by their paths, so no other folder is
  listed) and joined to the changes by key: a change that is not older than the row it
  meets replaces its columns, so replaying a batch or applying an older change never
  regresses a row ("latest wins"), and a change of the same instant corrects it;
* nothing that a manifest names is ever overwritten.  Readers follow the newest complete
  manifest: they see the table before a merge or after it, also when the merge
  breaks off anywhere.  A replay after a crash does the whole merge anew.

The manifest also holds the table's columns, so a merge may add some (``evolve``): rows
written before are null there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewater.operators.relational import dedup_latest
from tidewater.session import delete_path, materialize, scratch_scope

BUCKET = "_bucket"
DATA, MANIFESTS = "data", "manifests"       # folders of a target


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, largest first; none when it is absent."""
    fs, p = _fs(spark, folder)
    return sorted((s.getPath().getName() for s in fs.listStatus(p)), reverse=True) if fs.exists(p) else []


def _manifest(spark: SparkSession, target: str, name: str) -> dict | None:
    """A manifest's content; None while it is being written, or if its writer broke off."""
    text = spark.read.text(f"{target}/{MANIFESTS}/{name}", wholetext=True).first()
    try:
        return json.loads(text[0]) if text else None
    except ValueError:
        return None


def _state(spark: SparkSession, target: str, version: int | None = None) -> dict | None:
    """The newest complete manifest (or that of ``version``)."""
    for name in _names(spark, f"{target}/{MANIFESTS}"):
        if version is None or int(name.partition(".")[0]) == version:
            found = _manifest(spark, target, name)
            if found:
                return found
    return None


def versions(spark: SparkSession, target: str) -> list[int]:
    """Versions of the table that can still be read, newest first."""
    return [int(n.partition(".")[0]) for n in _names(spark, f"{target}/{MANIFESTS}") if _manifest(spark, target, n)]


def _commit(spark: SparkSession, target: str, state: dict) -> None:
    """Write the manifest of a version that must not exist yet."""
    fs, p = _fs(spark, f"{target}/{MANIFESTS}/{state['version']:012d}.json")
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        raise RuntimeError(f"another merge wrote version {state['version']} of {target} first") from e
    out.write(bytearray(json.dumps(state).encode()))
    out.close()


def _clean(spark: SparkSession, target: str, keep: int) -> None:
    """Forget all but the ``keep`` newest versions: their manifests, and the buckets that only they name."""
    names = _names(spark, f"{target}/{MANIFESTS}")
    known = [(n, _manifest(spark, target, n)) for n in names]
    kept = [(n, m) for n, m in known if m][:keep]
    used = {(folder, b) for _, m in kept for b, folder in m["folders"].items()}
    newest = kept[0][1]["version"]
    for name, m in known:
        if name < kept[-1][0]:
            for b, folder in (m or {"folders": {}})["folders"].items():
                if (folder, b) not in used:
                    delete_path(spark, f"{target}/{DATA}/{folder}/{BUCKET}={b}")
            delete_path(spark, f"{target}/{MANIFESTS}/{name}")
    live = {folder for folder, _ in used}
    for folder in _names(spark, f"{target}/{DATA}"):
        if folder not in live and int(folder.partition("-")[0]) <= newest:     # a later one may be a merge at work
            delete_path(spark, f"{target}/{DATA}/{folder}")


def _read(spark: SparkSession, target: str, folders: dict[str, str], schema: StructType) -> DataFrame:
    paths = [f"{target}/{DATA}/{folder}/{BUCKET}={b}" for b, folder in sorted(folders.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _table_schema(state: dict | None, changes: StructType, keys: list[str], cols: Sequence[str] | None, evolve: bool) -> StructType:
    """The table's columns after the merge, or a refusal."""
    nullable = [StructField(f.name, f.dataType, True) for f in changes.fields]
    if state is None:
        return StructType(nullable)
    table = StructType.fromJson(state["schema"])
    new = [f for f in nullable if f.name not in table.names]
    if new and not evolve:
        raise ValueError(f"the table has no columns {[f.name for f in new]}: merge with evolve=True to add them, or name others in cols")
    missing = [n for n in table.names if n not in changes.names]
    if missing and cols is None:
        raise ValueError(f"the changes have no columns {missing}: name the columns to be updated in cols")
    return StructType(table.fields + new)


def merge_upsert(spark: SparkSession, target: str, changes: DataFrame, key: Sequence[str] | str,
                 order: Sequence[str], buckets: int = 64, cols: Sequence[str] | None = None,
                 evolve: bool = False, keep: int = 2) -> int:
    """K2: matched keys take the latest change, new keys are inserted.  Returns the number of buckets rewritten.

    Among changes of equal ``order`` the largest remaining columns win; a change
    of equal ``order`` replaces the current row (a corrected file updates it).

    ``cols`` names the columns that are updated and inserted (all of the table's by default; key and
    ``order`` always are): other columns keep their value in matched rows and are null in new ones.  A
    column that the table does not have is added with ``evolve`` and refused without.

    ``buckets`` fixes the table's layout: a merge rewrites every bucket its
    changes touch, so size it to the table (roughly one bucket per 0.5-1 GB of
    target data).  It is stored with the table, and a different count is refused.
    ``keep`` versions stay readable, for readers that began before this merge.  Of two merges at the same
    time one is refused."""
    keys = [key] if isinstance(key, str) else list(key)
    state = _state(spark, target)
    if state is not None and state["buckets"] != buckets:
        raise ValueError(f"{target} has {state['buckets']} buckets, not {buckets}")
    if cols is not None:
        changes = changes.select(*dict.fromkeys([*keys, *order, *cols]))
    schema = _table_schema(state, changes.schema, keys, cols, evolve)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    with scratch_scope(spark):
        latest = dedup_latest(changes, keys, order).select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields if f.name in changes.columns])
        latest = materialize(latest.select("*", bucket), "changes")
        touched = [r[0] for r in latest.select(BUCKET).distinct().collect()]        # at most ``buckets`` numbers
        if not touched:
            return 0
        folders = state["folders"] if state else {}
        current = _read(spark, target, {str(b): folders[str(b)] for b in touched if str(b) in folders}, schema)
        merged = _merge(current, latest.drop(BUCKET), keys, list(order))
        number = max([state["version"] if state else 0, *(int(n.partition(".")[0]) for n in _names(spark, f"{target}/{MANIFESTS}"))]) + 1
        folder = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        _write(merged.select("*", bucket), f"{target}/{DATA}/{folder}")
    _commit(spark, target, {"version": number, "buckets": buckets, "schema": json.loads(schema.json()),
                            "folders": folders | {str(b): folder for b in touched}})
    _clean(spark, target, keep)
    return len(touched)


def _merge(current: DataFrame, latest: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of both sides by key (unique on each, so no key is hot); the change where it is not older."""
    old, new = (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)) for df, name in ((current, "_old"), (latest, "_new")))
    on = None
    for k in keys:
        same = F.col("_old")[k].eqNullSafe(F.col("_new")[k])
        on = same if on is None else on & same
    instant = [F.struct(*[F.col(side)[c] for c in order]) for side in ("_new", "_old")]
    wins = F.col("_old").isNull() | (F.col("_new").isNotNull() & (instant[0] >= instant[1]))
    return old.join(new, on, "full").select(*[
        (F.when(wins, F.col("_new")[c]).otherwise(F.col("_old")[c]) if c in latest.columns else F.col("_old")[c]).alias(c) for c in current.columns])


def _write(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)


def current_state(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The upserted table as of its newest version (or of one that is still kept)."""
    state = _state(spark, target, version)
    if state is None:
        raise ValueError(f"no table at {target}" + (f" in version {version}" if version is not None else ""))
    return _read(spark, target, state["folders"], StructType.fromJson(state["schema"]))


def change_batch_handler(spark: SparkSession, target: str, key: Sequence[str] | str, order: Sequence[str],
                         buckets: int = 64, log: str | None = None, cols: Sequence[str] | None = None, evolve: bool = False):
    """K1 / K3 / K4: a ``foreachBatch`` function applying each micro-batch of the
    change stream with :func:`merge_upsert`.  Empty batches are skipped (no
    merge without changes); with ``log`` a row per applied batch is appended."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        n = merge_upsert(spark, target, batch, key, order, buckets, cols, evolve)
        if log:
            from tidewater.sources.writers import write_batch
            write_batch(spark.createDataFrame([(n,)], "buckets long").withColumn("merged_at", F.current_timestamp()),
                        log, batch_id)
    return handle
