"""Path helpers on the cluster file system (Hadoop FS through the session)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete of one directory (used for partitions a delete emptied)."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (none if it isn't there)."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
