"""Incremental raw -> Bronze with Structured Streaming.

The file source remembers in its checkpoint which files it has read, so each
run ingests exactly the envelope files not yet seen; ``availableNow`` drains
them in bounded micro-batches and stops. Same transforms as the batch step.

Each micro-batch is appended to Bronze as the batch step appends, with no sink
log in the Bronze folder, so C2 and C3 may rewrite it. A small record under
``<checkpoint>/applied`` names each applied batch; a batch that is handed over
again after a restart is passed over. (Between the append's commit and that
record a crash can repeat one micro-batch: plain files have no transaction
over both.)
"""

from __future__ import annotations

import datetime as _dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.keys import bloom_options
from strata.functions.metadata import DEFAULT_DATASOURCE, ingest_metadata, with_stored_digest
from strata.plans.raw_to_bronze import stores_digest
from strata.schemas import BRONZE_PARTITION, BRONZE_WRITE_ORDER
from strata.sinks.files import path_exists
from strata.sinks.writers import append_partitioned
from strata.sources.raw import read_raw

PROGRESS_DDL = "name STRING, batchId BIGINT, numInputRows BIGINT"


def raw_stream(spark: SparkSession, raw_dir: str,
               max_files_per_trigger: int | None = None, multiline: bool = False,
               archive_dir: str | None = None) -> DataFrame:
    """Streaming S1: the raw text of the files not yet seen, a row for each document.

    The records are read from the micro-batch's files by the batch reader (see
    ``apply_batch``), so a stream accepts, rejects and keeps exactly what a
    batch does. ``max_files_per_trigger`` bounds each micro-batch. ``archive_dir`` moves
    processed files out of the source folder (``cleanSource=archive``), so
    the listing each trigger performs does not grow with history.
    """
    r = spark.readStream.format("text").option("wholetext", multiline)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(raw_dir).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def _named(path: str) -> str:
    """A file's URI as a reader's path: escapes undone, pattern characters taken literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def file_names(documents: DataFrame) -> dict[str, int]:
    """The files of a micro-batch, and how many documents each holds.

    ``max_files_per_trigger`` names at most; the file source's own log lists them too.
    """
    held = ~F.col("document").rlike(r"^\s*$")
    return {_named(r.path): r.n for r in documents.groupBy("path").agg(F.count_if(held).alias("n")).collect()}


def _applied(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/applied"


def apply_batch(documents: DataFrame, batch_id: int, bronze_path: str, checkpoint: str, name: str,
                datasource: str = DEFAULT_DATASOURCE, ingest_ts: _dt.datetime | str | None = None,
                store_digest: bool | None = None, rejects: str = "fail", multiline: bool = False) -> bool:
    """Append one micro-batch of raw documents to Bronze, once; False if it was applied before.

    The files of the micro-batch are read by ``read_raw``.
    """
    spark = documents.sparkSession
    done = f"{_applied(checkpoint)}/batch-{batch_id:012d}"
    if path_exists(spark, f"{done}/_SUCCESS"):
        return False
    files = file_names(documents)
    if files:
        raw = read_raw(spark, list(files), multiline=multiline, rejects=rejects)
        rows = ingest_metadata(raw, datasource, ingest_ts).select(*BRONZE_WRITE_ORDER)
        if stores_digest(spark, bronze_path, store_digest):
            rows = with_stored_digest(rows)
        append_partitioned(rows, bronze_path, BRONZE_PARTITION, options=bloom_options(rows.columns, "movie"))
    (spark.createDataFrame([(name, batch_id, sum(files.values()))], PROGRESS_DDL).coalesce(1)
     .write.mode("overwrite").json(done))
    return True


def start_raw_to_bronze(spark: SparkSession, raw_dir: str, bronze_path: str,
                        checkpoint: str, name: str,
                        datasource: str = DEFAULT_DATASOURCE,
                        ingest_ts: _dt.datetime | str | None = None,
                        available_now: bool = True,
                        max_files_per_trigger: int | None = None,
                        multiline: bool = False,
                        archive_dir: str | None = None,
                        store_digest: bool | None = None, rejects: str = "fail") -> StreamingQuery:
    """Start the named stream appending to Bronze (partitioned Parquet)."""
    src = raw_stream(spark, raw_dir, max_files_per_trigger=max_files_per_trigger,
                     multiline=multiline, archive_dir=archive_dir)

    def apply(documents: DataFrame, batch_id: int) -> None:
        apply_batch(documents, batch_id, bronze_path, checkpoint, name, datasource, ingest_ts,
                    store_digest, rejects, multiline)

    w = src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    query = w.start()
    query.applied = _applied(checkpoint)
    return query


def run_raw_to_bronze(spark: SparkSession, raw_dir: str, bronze_path: str,
                      checkpoint: str, name: str, **kw) -> StreamingQuery:
    """R1, run to completion (``availableNow``): returns the finished query."""
    q = start_raw_to_bronze(spark, raw_dir, bronze_path, checkpoint, name, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def progress_rows(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """R2: ``(name, batchId, numInputRows)`` for each micro-batch that the queries' streams applied.

    Read from the records beside the checkpoints, so every batch is there:
    those of earlier runs, and more than the session retains in
    ``recentProgress``. ``numInputRows`` counts envelopes, not exploded records.
    """
    paths = sorted({f"{q.applied}/*" for q in queries if path_exists(spark, q.applied)})
    if not paths:
        return spark.createDataFrame([], PROGRESS_DDL)
    return spark.read.schema(PROGRESS_DDL).json(paths)


def is_ready(query: StreamingQuery, progressions: int = 3) -> bool:
    """A non-blocking form of the readiness poll: has ``query`` reported enough?"""
    return len(query.recentProgress) >= progressions
