"""Raw envelope files -> Bronze (S1 -> P1 -> V1 -> K1 -> K8)."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strata.functions.keys import bloom_options, stored_digest_name
from strata.functions.metadata import DEFAULT_DATASOURCE, ingest_metadata, with_stored_digest
from strata.operators.quality import assert_schema
from strata.schemas import BRONZE_PARTITION, BRONZE_SCHEMA, BRONZE_WRITE_ORDER
from strata.sinks.catalog import register_table
from strata.sinks.files import child_names, path_exists
from strata.sinks.writers import append_partitioned, rebuild_partitioned
from strata.sources.raw import read_raw


def bronze_batch(spark: SparkSession, raw_path: str, datasource: str = DEFAULT_DATASOURCE,
                 ingest_ts: _dt.datetime | str | None = None, key: str = "movie",
                 multiline: bool = False, encoding: str | None = None,
                 rejects: str = "fail") -> DataFrame:
    """S1 + P1 + V1: the Bronze rows of one raw batch (not yet written)."""
    raw = read_raw(spark, raw_path, key, multiline=multiline, encoding=encoding, rejects=rejects)
    bronze = ingest_metadata(raw, datasource, ingest_ts, key)
    if key == "movie":
        assert_schema(bronze, BRONZE_SCHEMA)
    return bronze


def stores_digest(spark: SparkSession, bronze_path: str, wanted: bool | None = None, rebuild: bool = False,
                  key: str = "movie") -> bool:
    """Whether rows written to this Bronze carry the digest: all of a table's rows do, or none.

    Rows without it in a table that has the column would never be matched. One
    partition is asked, not the table: an append lists no more than that.
    """
    if rebuild or not path_exists(spark, bronze_path):
        return wanted is not False
    parts = sorted(c for c in child_names(spark, bronze_path) if c.startswith(f"{BRONZE_PARTITION}="))
    one = spark.read.option("basePath", bronze_path) if parts else spark.read
    try:
        there = stored_digest_name(key) in one.parquet(
            f"{bronze_path.rstrip('/')}/{parts[-1]}" if parts else bronze_path).columns
    except AnalysisException as exc:  # a folder without files yet
        if "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        return wanted is not False
    if wanted is not None and wanted != there:
        raise ValueError(f"{bronze_path} {'stores' if there else 'does not store'} the digest: rebuild it to change that")
    return there


def raw_to_bronze(spark: SparkSession, raw_path: str, bronze_path: str,
                  table: str | None = None, datasource: str = DEFAULT_DATASOURCE,
                  ingest_ts: _dt.datetime | str | None = None,
                  rebuild: bool = False, multiline: bool = False,
                  store_digest: bool | None = None, encoding: str | None = None,
                  rejects: str = "fail") -> str:
    """Append (or, with ``rebuild``, replace) a raw batch into Bronze.

    Scan, explode, stamp and write run as one stage per input file: no
    shuffle. All rows of a batch share one ``p_ingestdate``, so the write is
    *not* repartitioned on it. ``multiline=True`` reads one document per file
    (see ``read_raw``, also for ``rejects``). With ``movie_digest`` beside the five
    reference columns later merges scan 8 bytes per row, not the text, and
    skip row groups by its Bloom filters (see ``with_stored_digest``). A new or rebuilt
    table stores it, an existing one goes on as it is; ``store_digest=False`` leaves it out.
    """
    out = bronze_batch(spark, raw_path, datasource, ingest_ts, multiline=multiline,
                       encoding=encoding, rejects=rejects).select(*BRONZE_WRITE_ORDER)
    if stores_digest(spark, bronze_path, store_digest, rebuild):
        out = with_stored_digest(out)
    write = rebuild_partitioned if rebuild else append_partitioned
    write(out, bronze_path, BRONZE_PARTITION, options=bloom_options(out.columns, "movie"))
    if table:
        register_table(spark, table, bronze_path)
    return bronze_path
