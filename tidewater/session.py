"""Session construction and the shared scratch location.

Intermediate data (round-trip files, stream checkpoints, lineage cuts) goes under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that setting
is absent (unit tests, a bare laptop session) do we create a local folder and
register it as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "tidewater", master: str | None = None,
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_shipped: set[str] = set()
_scratch: list[str] = []      # folders that materialize() has written


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once for each application.

    Functions passed to Spark are pickled by reference, so workers must be able to
    import the package wherever the driver was started.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):     # else the package itself runs from a shipped archive
        path = os.path.join(tempfile.mkdtemp(prefix="tidewater-"), "tidewater.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base:
        return base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh (not yet existing) folder under the shared checkpoint location for one run of ``name``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    if base.startswith("file:"):      # plain paths also serve Python readers on the driver
        base = "/" + base[len("file:"):].lstrip("/")
    # the leaf does not exist yet, so writers in their default mode accept it; Spark makes the parents
    return f"{base.rstrip('/')}/tidewater-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint location
    and read it back.

    Later stages (and retries after a lost executor) read the files instead of
    recomputing the plan.  Parquet is columnar and compressed, so this is cheaper
    than an RDD ``checkpoint()`` of the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    _scratch.append(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the cluster's file system; nothing happens when it is absent."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at the end, what was materialized inside.

    For steps that write their own result: frames that are read lazily after the
    scope must not depend on anything materialized in it.
    """
    start = len(_scratch)
    try:
        yield
    finally:
        for path in _scratch[start:]:
            delete_path(spark, path)
        del _scratch[start:]
