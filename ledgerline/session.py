"""Spark session defaults for billing jobs.

Cluster settings win: every option below is applied only when the
cluster (spark-defaults, ``--conf``) has not already set it.  The values
are chosen for scale, not for the laptop: AQE re-plans joins and
coalesces shuffle partitions at run time, so a generous initial
partition count costs nothing on small inputs and keeps partitions
small enough to avoid spill on large ones.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults applied only where the session leaves a key unset.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Broadcast is decided by Spark from measured/estimated size, never
    # forced: a side above this bound gets a sort-merge or shuffled hash
    # join instead.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with the billing defaults.

    ``master`` is only for local runs and tests; on a cluster leave it
    ``None`` so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if master:
        builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Only what neither the cluster nor the caller has named.
    given = spark.sparkContext.getConf()
    for key, value in SESSION_DEFAULTS.items():
        if not given.contains(key) and key not in (extra or {}):
            spark.conf.set(key, value)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL defaults on an existing session where unset."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``; only when it is unset and the
    master is local (local runs, tests) a fresh scratch folder is created
    and registered.  On a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder is not visible to other executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the folder that ``spark.checkpoint.dir`` names, for
    tables that outlive the application."""
    own = checkpoint_dir(spark)
    return os.path.join(spark.conf.get("spark.checkpoint.dir", None) or own, name)
