"""R1 -> C2 in one micro-batch: raw files to Bronze and Silver, no merge.

A micro-batch's records are read, parsed and classified once and staged. Their Bronze
rows are written with their final status, so no later merge has to find them;
the clean ones go to Silver. Both layers take the micro-batch as a partition
of its own (``p_batch``, see ``strata.sinks.batches``) by a dynamic overwrite,
so a batch that is handed over again after a crash replaces what it
had written: exactly once, wherever it died.

Bronze rows equal those of R1 followed by C2 (``loaded``, ``quarantined`` or
``new``), Silver rows too (they keep the status ``new``). C3 follows as usual,
with ``repeatable=True``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.functions.keys import bloom_options
from strata.functions.metadata import DEFAULT_DATASOURCE, ingest_metadata, with_stored_digest
from strata.functions.records import parse_records
from strata.operators.quality import OUTCOME, outcome_column
from strata.schemas import BRONZE_PARTITION, BRONZE_WRITE_ORDER, SILVER_COLUMNS, SILVER_PARTITION
from strata.sinks.batches import write_batch
from strata.sinks.staging import stage
from strata.sources.raw import read_raw
from strata.streaming.bronze_stream import file_names, raw_stream

def apply_medallion_batch(documents: DataFrame, batch_id: int, bronze_path: str, silver_path: str, name: str,
                          datasource: str = DEFAULT_DATASOURCE, ingest_ts: _dt.datetime | str | None = None,
                          nulls: str = "leave", rejects: str = "fail", multiline: bool = False) -> None:
    """Write one micro-batch to both layers; again, if it was written before."""
    spark = documents.sparkSession
    files = file_names(documents)
    if not files:
        return
    raw = read_raw(spark, list(files), multiline=multiline, rejects=rejects)
    new = ingest_metadata(raw, datasource, ingest_ts)
    parsed = parse_records(new, keep=("datasource", "ingesttime", "status", "p_ingestdate")).withColumn(
        OUTCOME, outcome_column(nulls=nulls))
    batch = stage(spark, parsed, "stream-batch")
    part = f"{name}-{batch_id:012d}"
    bronze = with_stored_digest(batch.withColumn("status", F.col(OUTCOME)).select(*BRONZE_WRITE_ORDER))
    write_batch(bronze, bronze_path, BRONZE_PARTITION, part, options=bloom_options(bronze.columns, "movie"))
    write_batch(batch.where(F.col(OUTCOME) == "loaded").select(*SILVER_COLUMNS), silver_path, SILVER_PARTITION, part)


def run_raw_to_silver(spark: SparkSession, raw_dir: str, bronze_path: str, silver_path: str, checkpoint: str,
                      name: str, max_files_per_trigger: int | None = None, multiline: bool = False,
                      archive_dir: str | None = None, **how) -> StreamingQuery:
    """The files not yet seen, through both layers, until none is left (``availableNow``)."""
    src = raw_stream(spark, raw_dir, max_files_per_trigger, multiline, archive_dir)

    def apply(documents: DataFrame, batch_id: int) -> None:
        apply_medallion_batch(documents, batch_id, bronze_path, silver_path, name, multiline=multiline, **how)

    query = (src.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(name)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query
