"""Table and path scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _is_path(source: str) -> bool:
    return "/" in source or ":" in source


def read_source(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a lake table by path."""
    return spark.read.format(fmt).load(source) if _is_path(source) else spark.table(source)


def read_by_status(spark: SparkSession, source: str, status: str = "new",
                   fmt: str = "parquet", partition_filter=None) -> DataFrame:
    """Rows of a layer with a given ``status``.

    The equality is pushed to the Parquet scan; an optional partition filter
    (e.g. ``F.col("p_ingestdate") >= "2024-01-01"``) prunes directories.
    """
    df = read_source(spark, source, fmt).where(F.col("status") == status)
    return df.where(partition_filter) if partition_filter is not None else df


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return spark.read.parquet(path)
