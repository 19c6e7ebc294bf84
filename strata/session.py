"""Session construction and the shared scratch area.

Intermediate results that must outlive a task (staged merges, landing batches,
fixture envelopes) are written under the folder the cluster names in
``spark.checkpoint.dir``. The setting is read from the session; a private
folder is created only when it is unset (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "strata", **extra: str) -> SparkSession:
    """A session with the settings the library assumes (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged data: ``spark.checkpoint.dir`` if set.

    When the session names none (tests, local runs) a fresh private folder is
    created and installed as the checkpoint directory, so ``checkpoint()``
    and staged writes land in the same place. On a cluster an unset folder is
    an error: each machine would write to its own disk.
    """
    conf_dir = spark.conf.get(_CHECKPOINT_KEY, None)
    if conf_dir:
        _ensure_context_dir(spark, conf_dir)
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="strata-run-", dir="/tmp")
    spark.conf.set(_CHECKPOINT_KEY, local)
    sc.setCheckpointDir(local)
    return local


def _ensure_context_dir(spark: SparkSession, folder: str) -> None:
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never-used path under the scratch root (not created)."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique table name."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
