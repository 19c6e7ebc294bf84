"""Repeatable batch appends: a run that dies midway is completed, not repeated.

C2 and C3 write twice: rows to Silver, then statuses to Bronze. Plain files have no
transaction over both, so a step that dies in between and is run again would
append its rows a second time. With a record of the batch at work it isn't:

1. the batch is staged (its rows can be read again, whatever happens to Bronze);
2. a record beside the layer, ``<layer>/_pending``, names the staged batch;
3. its rows are written to a partition of their own, ``p_batch=<id>``, by a
   dynamic overwrite: writing them again replaces them;
4. the statuses are merged (merging twice equals merging once);
5. the record goes.

The next run of any step that finds a record does 3 to 5 for it first. The
record is complete once its ``_SUCCESS`` is there, and nothing is appended
before that. ``_pending`` is hidden from scans of the layer.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.files import path_exists, remove_path

#: Partition column of a layer that is appended in repeatable batches.
BATCH = "p_batch"


def _record(layer: str) -> str:
    return f"{layer.rstrip('/')}/_pending"


def begin(spark: SparkSession, layer: str, step: str, staged: str, settings: dict[str, Any]) -> dict[str, Any]:
    """Record the staged batch that ``step`` is about to append to ``layer``."""
    record = {"step": step, "batch": staged.rstrip("/").rsplit("/", 1)[-1], "staged": staged, "settings": settings}
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(_record(layer))
    return record


def pending(spark: SparkSession, layer: str) -> dict[str, Any] | None:
    """The record of a batch that was begun and not finished."""
    if not path_exists(spark, f"{_record(layer)}/_SUCCESS"):
        return None
    record = json.loads(spark.read.text(_record(layer)).collect()[0].value)
    if not path_exists(spark, f"{record['staged']}/_SUCCESS"):
        raise RuntimeError(f"{layer} has an unfinished batch whose staged rows are gone: {record['staged']}")
    return record


def finish(spark: SparkSession, layer: str) -> None:
    remove_path(spark, _record(layer))


def write_batch(rows: DataFrame, layer: str, partition_column: str, batch: str, fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> None:
    """Append ``rows`` as the layer's batch ``batch``, or replace what that batch has written."""
    (rows.withColumn(BATCH, F.lit(batch)).write.format(fmt).options(**(options or {})).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_column, BATCH).save(layer))


def layer_rows(spark: SparkSession, layer: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a layer without the batch column."""
    return spark.read.format(fmt).load(layer).drop(BATCH)
