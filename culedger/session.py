"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

#: Settings that matter at scale; applied by :func:`build_session` and safe to
#: set on an existing session with :func:`apply_defaults`.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension joins broadcast only under this measured size; above it the
    # planner (and AQE at run time) keeps a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Local (single-JVM) runs: small inputs should still use every core, so AQE
#: may keep shuffle partitions down to 32 KB instead of merging them into one
#: or two tasks.
LOCAL_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
}

#: Suggested cluster profile (not applied automatically; a cluster's own
#: configuration wins). Size ``spark.sql.shuffle.partitions`` to roughly the
#: largest shuffle's bytes / 200 MB; AQE then merges small partitions toward
#: the advisory size instead of maximising task count on a busy cluster.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "culedger", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULTS)
    if master.startswith("local"):
        conf.update(LOCAL_SETTINGS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for k, v in DEFAULTS.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only where it is unset on a local master (tests) is
    a folder of our own set: on a cluster each machine has its own /tmp, so an
    unset folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if fallback is None and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = fallback or os.path.join(os.environ.get("CULEDGER_SCRATCH", "/tmp"), f"culedger-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared work folder (a sibling of the checkpoints),
    for staging and snapshots that every executor must see."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # getCheckpointDir() is ``<dir>/<uuid>``; work files live next to it.
    root = base.rsplit("/", 1)[0] if "/" in base else base
    return "/".join([root, "culedger-work", *parts])
