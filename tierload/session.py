"""Spark session defaults and the shared work folder.

Every operator in the package is a lazy ``DataFrame -> DataFrame``
function; the only things that need a place on disk are table
snapshots and Bronze fixtures written for discovery tests.  They go
below the folder the cluster names in ``spark.checkpoint.dir`` so
they are visible to every executor and survive executor loss.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the operators rely on.  Time zone UTC so naive
# timestamps round-trip; ANSI on (Spark 4 default) so bad casts raise
# like the SQL engines the loaders target; partition values stay
# strings, as the catalog declares them.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Keyed table versions hold one sorted file per bucket, so a bucketed
    # scan can report its sort order and the MERGE join skips sorting the
    # large side (Spark only claims the order when a bucket has one file).
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def build_session(master: str | None = None, app: str = "tierload",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass


def work_dir(spark: SparkSession) -> str:
    """The shared folder for snapshots and lineage cuts.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only when neither is set -- local runs and tests -- a fresh
    temporary folder is created and registered as the checkpoint dir.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.sparkContext.getCheckpointDir()
        except Exception:
            path = None
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tierload-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the work dir."""
    base = work_dir(spark)
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"
