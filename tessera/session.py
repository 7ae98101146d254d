"""Session construction and cluster-facing settings."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package assumes: UTC wall clock (the oracle engine
# treats timestamps as naive UTC), adaptive execution for runtime re-planning
# (partition coalescing, skew-join splitting, size-checked broadcast), ANSI on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints written by `materialize` are removed once their data is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - no SparkContext under Spark Connect
        pass
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, wiring it into the SparkContext.

    The folder comes from ``spark.checkpoint.dir`` (the shared folder a cluster
    names). Only a local-mode session without that setting (tests) gets its own
    folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the reliable checkpoint folder (stream state, sinks)."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return os.path.join(base, "tessera", *parts)


def materialize(df):
    """Write ``df`` once to the reliable checkpoint folder and continue from it.

    Used for small derived tables (one row per customer) that several later
    steps read — the count that sizes value ranges, the quantile branch, the
    scoring branch, the scaler fit and apply. Without it each consumer would
    re-run the full scan and shuffle of the raw tables; with it the raw
    tables are read once and lineage is cut (an executor loss re-reads the
    checkpoint instead of recomputing the pipeline).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, name: str):
    """Write ``df`` once as Parquet below the shared folder and read it back: lineage ends here, and later
    steps read only the columns they need."""
    path = scratch_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- folders in the shared store (any file system that Spark reads) ---------------------------
def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` whose writer has finished (they hold ``_SUCCESS``)."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    below = [s.getPath() for s in fs.listStatus(target) if s.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(b.getName() for b in below if fs.exists(done(b, "_SUCCESS")))


def files_in(spark: SparkSession, path: str) -> int:
    """Number of data files directly in a folder (0 if there is none)."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return 0
    return sum(s.isFile() and s.getPath().getName()[0] not in "._" for s in fs.listStatus(target))


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what it holds, if it is there."""
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
