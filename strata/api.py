"""Function-level entry points with the source pipeline's names and arguments.

A user of the source notebooks can call these in place of the originals; each
delegates to the library operator. Explicit arguments replace notebook
globals (``spark``, paths, the clock).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from strata.functions.metadata import DEFAULT_DATASOURCE, ingest_metadata
from strata.functions.records import transform_bronze as _transform_bronze
from strata.operators.landing import land_next_batch, prepare_activity_path
from strata.operators.merge import merge_update_path
from strata.operators.quality import split
from strata.operators.repair import TypedRepair, repair_by_lookup, repair_typed
from strata.schemas import BRONZE_PARTITION, STATUS_NEW, STATUS_QUARANTINED
from strata.sinks.writers import batch_writer as _batch_writer
from strata.sources.raw import read_raw
from strata.sources.tables import read_by_status, read_source
from strata.streaming.bronze_stream import is_ready


def read_batch_raw(spark: SparkSession, raw_path: str, multiline: bool = False,
                   encoding: str | None = None, rejects: str = "fail") -> DataFrame:
    """Raw envelope files -> one row per record text (``movie``); see ``read_raw``."""
    return read_raw(spark, raw_path, multiline=multiline, encoding=encoding, rejects=rejects)


def transform_raw(raw: DataFrame, datasource: str = DEFAULT_DATASOURCE,
                  ingest_ts: _dt.datetime | str | None = None) -> DataFrame:
    """Ingestion metadata: ``datasource, ingesttime, status, movie, p_ingestdate``."""
    return ingest_metadata(raw, datasource, ingest_ts)


def read_batch_bronze(spark: SparkSession, bronze: str = "bronze_movie") -> DataFrame:
    """Bronze rows with ``status = 'new'`` (table name or path)."""
    return read_by_status(spark, bronze, STATUS_NEW)


def read_batch_delta(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A lake table by path (``fmt="delta"`` where that format is installed)."""
    return read_source(spark, path, fmt)


def transform_bronze(bronze: DataFrame, quarantine: bool = False) -> DataFrame:
    """Parse, unpack to the 22 record columns, drop exact duplicates.

    ``quarantine`` is accepted for compatibility; as in the source it changes
    nothing.
    """
    return _transform_bronze(bronze)


def generate_clean_and_quarantine_dataframes(dataframe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(clean, quarantine)``; rows meeting neither predicate are in neither
    (use :func:`strata.operators.quality.split` for the third set)."""
    clean, quarantine, _ = split(dataframe)
    return clean, quarantine


def batch_writer(dataframe: DataFrame, partition_column: str,
                 exclude_columns: Sequence[str] = (), mode: str = "append",
                 fmt: str = "parquet") -> DataFrameWriter:
    """An unsaved writer: columns dropped, format, mode, partitioning set."""
    return _batch_writer(dataframe, partition_column, exclude_columns, mode, fmt)


def update_bronze_table_status(spark: SparkSession, bronze_table_path: str,
                               dataframe: DataFrame, status: str,
                               key: str = "movie") -> bool:
    """Set ``status`` on every Bronze row whose record text is in ``dataframe``.

    Plain Parquet has no snapshots: an update rewrites the touched Bronze
    files. A DataFrame planned over Bronze *before* an update must therefore
    be staged (``strata.sinks.staging.stage``) before the first update, as
    ``bronze_to_silver`` does, or it would read files that are gone.
    """
    merge_update_path(spark, bronze_table_path, dataframe.select(key), key,
                      {"status": F.lit(status)}, partition_by=(BRONZE_PARTITION,),
                      check_unambiguous=False)
    return True


def repair_quarantined_records(spark: SparkSession, bronze: str, user_table: str,
                               projection: Mapping[str, Column],
                               left_on: str = "device_id", right_on: str = "user_id",
                               parse=None) -> DataFrame:
    """Quarantined Bronze rows joined to a lookup table (inner), then projected.

    ``parse`` turns the quarantined Bronze rows into typed columns (default:
    the record transform); ``projection`` maps output names to expressions
    over ``q.*`` (quarantined) and ``u.*`` (lookup).
    """
    q = read_by_status(spark, bronze, STATUS_QUARANTINED)
    q = (parse or transform_bronze)(q)
    return repair_by_lookup(q, read_source(spark, user_table), left_on, right_on, projection)


def repair_quarantined_records_typed(spark: SparkSession, bronze: str, user_table: str,
                                     projection: Mapping[str, tuple[Column, str]],
                                     left_on: str = "device_id", right_on: str = "user_id",
                                     parse=None) -> TypedRepair:
    """The same repair with ``try_cast``: repaired, rejected and unmatched rows, each counted.

    ``projection`` maps output names to ``(expression, type)``; see ``repair_typed``.
    """
    q = (parse or transform_bronze)(read_by_status(spark, bronze, STATUS_QUARANTINED))
    return repair_typed(spark, q, read_source(spark, user_table), left_on, right_on, projection)


def prepare_activity_data(spark: SparkSession, activity: DataFrame, landing_path: str,
                          tz: str | None = None) -> bool:
    """Epoch ``time`` -> text plus ``day, month, hour``; written once as the backlog."""
    prepare_activity_path(spark, activity, landing_path, tz=tz)
    return True


def ingest_classic_data(spark: SparkSession, landing_path: str, raw_path: str,
                        hours: int = 1, tie_breaker: str | Sequence[str] = (),
                        batch_name: str | None = None) -> bool:
    """Land the next ``10 * hours`` backlog rows as JSON lines and delete them.

    Returns ``False`` when the backlog is empty. A ``tie_breaker`` that is
    unique in the backlog is required: it makes the batch a total order.
    """
    if batch_name is None:
        batch_name = _dt.datetime.now().strftime("%Y-%m-%d-%H-%M-%S-%f")
    return land_next_batch(spark, landing_path, raw_path, hours, tie_breaker,
                           batch_name=batch_name) is not None


# The readiness poll is re-aimed: use strata.streaming.bronze_stream.is_ready
# (non-blocking) and progress_rows (progress reports as rows).
__all__ = [
    "read_batch_raw", "transform_raw", "read_batch_bronze", "read_batch_delta",
    "transform_bronze", "generate_clean_and_quarantine_dataframes", "batch_writer",
    "update_bronze_table_status", "repair_quarantined_records", "repair_quarantined_records_typed",
    "prepare_activity_data",
    "ingest_classic_data", "is_ready",
]
