"""Spark session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ledgerline job relies on.  Timestamps are naive wall-clock
# values, so the session time zone is pinned to UTC; ANSI mode makes bad casts
# fail instead of turning into NULL; AQE re-plans joins from runtime sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove checkpoint files (size-checked broadcast sides) once their
    # DataFrame is garbage-collected, so long-running drivers do not
    # accumulate them.  Static: applies when ledgerline creates the context.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Stateful streaming keeps its state in RocksDB (off-heap, spills to local
# disk, incremental changelog checkpoints) instead of the JVM heap.
STREAMING_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Return a session with the core settings applied.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data (about 128-256 MB per partition); AQE
    coalesces small ones at runtime.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf of an already running session
            pass
    return spark


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable core settings to an existing session."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:
            pass
    return spark


_STATE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
}


def apply_streaming_state_conf(spark: SparkSession) -> SparkSession:
    """Use the RocksDB state store unless the session chose something else.

    A setting still at Spark's default (and not given in the SparkConf) is
    replaced.  The provider is recorded in a query's checkpoint, so this only
    affects queries started from a fresh checkpoint.
    """
    given = spark.sparkContext.getConf()
    for k, v in STREAMING_STATE_CONF.items():
        if not given.contains(k) and spark.conf.get(k, _STATE_DEFAULTS[k]) == _STATE_DEFAULTS[k]:
            spark.conf.set(k, v)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, sink outputs and stream checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    without one (tests) gets a private folder; on a cluster a machine-local
    folder would be invisible to the executors, so the setting is required.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(HDFS / object store) for this cluster session")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique path under the scratch root (never reused)."""
    root = scratch_root(spark)
    path = f"{root}/ledgerline/{label}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path
