"""Layer writers.

No writer repartitions by the partition column: one ingest batch has a single
``p_ingestdate``, and hashing on it would send the whole batch to one task.
Each task writes its own files into the partition directories it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter


def _norm(path: str) -> str:
    p = "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
    return p.rstrip("/") + "/"


def assert_not_reading(df: DataFrame, path: str) -> None:
    """Refuse to overwrite ``path`` while ``df`` reads from it.

    A static overwrite deletes the target before the job has read it, so the
    result would be empty. The check lists ``df``'s input files (driver-side,
    the same listing the planner does) and costs no Spark job; it is meant
    for the small dimension tables K5 writes.
    """
    target = _norm(path)
    for f in df.inputFiles():
        if _norm(f).startswith(target):
            raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it")


def batch_writer(df: DataFrame, partition_column: str | None,
                 exclude_columns: Sequence[str] = (), mode: str = "append",
                 fmt: str = "parquet") -> DataFrameWriter:
    """K3: drop columns (unknown names ignored) and return an unsaved writer."""
    w = df.drop(*exclude_columns).write.format(fmt).mode(mode)
    return w.partitionBy(partition_column) if partition_column else w


def append_partitioned(df: DataFrame, path: str, partition_column: str,
                       columns: Sequence[str] | None = None, fmt: str = "parquet",
                       options: Mapping[str, str] | None = None) -> None:
    """K1/K2: append in a fixed column order, partitioned."""
    out = df.select(*columns) if columns else df
    out.write.format(fmt).options(**(options or {})).mode("append").partitionBy(partition_column).save(path)


def rebuild_partitioned(df: DataFrame, path: str, partition_column: str,
                        columns: Sequence[str] | None = None, fmt: str = "parquet",
                        options: Mapping[str, str] | None = None) -> None:
    """The first write of a rebuild replaces the whole layer (static overwrite).

    Never point this at a path ``df`` reads from (the raw input of a rebuild
    is another layer; its file list is not shipped to Python to check).
    """
    out = df.select(*columns) if columns else df
    (out.write.format(fmt).options(**(options or {})).mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(partition_column).save(path))


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K4: unpartitioned append."""
    df.write.format(fmt).mode("append").save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K5: unpartitioned overwrite; refuses a path ``df`` reads from."""
    assert_not_reading(df, path)
    df.write.format(fmt).mode("overwrite").save(path)


def write_new(df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: Sequence[str] = ()) -> None:
    """K6: default mode, fails if the path exists."""
    w = df.write.format(fmt).mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """K7: JSON lines; the output directory is the batch."""
    df.write.mode("errorifexists").json(path)
