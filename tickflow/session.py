"""Session helpers.

The engine pins the session time zone to UTC (bar edges, week starts and
epoch conversions must not depend on the machine's zone) and relies on AQE
for runtime re-planning. Scratch locations always come from the cluster's
``spark.checkpoint.dir``; a local fallback is created only when the setting
is absent (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every transform in the package assumes.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tickflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_RUNTIME_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stopGracefullyOnShutdown": "true",
        # staged frames (reliable checkpoints) are deleted once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared scratch root: the cluster's ``spark.checkpoint.dir``.

    Only a local master without one gets a private temporary directory; on a
    cluster a folder of the driver's own machine would be no use to executors,
    so an unset setting raises there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tickflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, deleted when
    the driver's JVM ends."""
    root = checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tickflow/{name}-{uuid.uuid4().hex[:12]}"
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def stage(df):
    """Materialise a frame that several branches of a plan consume (bars,
    feature tables) with a reliable checkpoint in the shared checkpoint
    directory: the upstream scan and aggregation run once, and a lost
    executor re-reads the checkpoint instead of recomputing from raw input.
    (Column pruning makes each branch's copy of the upstream plan different,
    so Spark cannot reuse the exchange between them.)"""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
