"""Session settings the results depend on, and where jobs may keep files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_ON_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tune(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC clocks; adaptive plans for skew.

    Streaming state goes to local disk rather than the heap, so that it may
    outgrow memory. Folders are listed by some hundred tasks rather than by one
    task each, thousands of them. Shuffle partitions and broadcast limits stay as the cluster
    sets them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ON_DISK_STATE)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "256")
    return spark


def build_session(master: str = "local[*]", app: str = "hazeline", **conf: str) -> SparkSession:
    """A session for local use and tests; on a cluster use the given one."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session without that
    setting gets a folder in /tmp; a cluster without it is refused, as its
    executors do not share a disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/hazeline/{purpose}-{uuid.uuid4().hex}"
