"""Session construction and the shared working folder.

Everything that must outlive a task (stream checkpoints, staged tables, cut
lineage) goes under the folder the cluster names in ``spark.checkpoint.dir``.
The setting is read from the session; a private folder is created only when it
is unset *and* the master is local (tests, laptops).  On a cluster an unset
value is an error rather than a silent machine-local path.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE coalesces small shuffle partitions,
# splits skewed join partitions, and converts joins to broadcast only when the
# runtime size of a side is under the threshold (a checked size with the
# shuffle join as the fallback).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # the planner sizes a file-based table by its compressed bytes; parquet
    # expands several-fold in memory, so scale the estimate before it is
    # compared with the automatic broadcast threshold
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # streaming state off the JVM heap: the latest-per-key views never expire keys
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # checkpoint only the state changes of each micro-batch, not full snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return (spark.conf.get("spark.master", "") or "").startswith("local")


def shared_root(spark: SparkSession) -> str:
    """Return the shared folder from ``spark.checkpoint.dir``.

    When unset on a local master, a private folder is created and registered
    (as the conf value and, on a classic session, as the RDD checkpoint dir)
    so that later calls agree.  On a cluster an unset value raises.  Only
    ``spark.conf`` is needed, so this also works over Spark Connect.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder "
            "(HDFS / object store) that every executor can reach"
        )
    root = tempfile.mkdtemp(prefix="strata-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    try:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    except Exception:  # noqa: BLE001 — no SparkContext on Spark Connect; the conf value suffices
        pass
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared root; ``unique`` appends a fresh run id."""
    pieces = [shared_root(spark), *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))
