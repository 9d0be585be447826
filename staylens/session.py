"""Session construction and the shared scratch folder.

Library code never builds its own session: every operator takes the caller's
``SparkSession`` (or DataFrames).  ``build_session`` is for tests, the bench
and command-line use only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are written against.  AQE re-plans joins from
# runtime sizes (checked broadcast, skew-join splitting, partition
# coalescing); ANSI makes bad casts and /0 fail loudly instead of silently
# producing NULL, so every division in the library is nullif-guarded.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the listings are joined and de-duplicated in one partitioning; a listing
    # that holds a large share of the rows is split all the same
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "staylens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session.  On a cluster, pass ``master=None`` and let
    spark-submit supply it; shuffle partitions should then be sized to the
    data (~128-256 MB of shuffle input per partition)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or f"local[{cpus}]")
    conf = dict(RECOMMENDED_CONF)
    conf.update(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": str(shuffle_partitions or int(cpus)),
            "spark.driver.memory": os.environ.get("STAYLENS_DRIVER_MEMORY", "16g"),
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            # remove checkpoint files once their RDD is garbage-collected
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        }
    )
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session (or the SparkContext's checkpoint dir).  When neither is set, a
    folder of this machine does for a local master only: executors elsewhere
    would not see it, so any other master is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="staylens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for written
    intermediate tables (lineage cuts, CSV landing zones, sink targets).
    Never a machine-local temp dir when the cluster names a shared one."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/staylens/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; a storage error is raised, never
    taken for an absent path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote and reads no more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def session_key(spark: SparkSession) -> str:
    """Identity of the running application, for per-session caches."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))
