"""P1 ingestion metadata (datasource, ingest time, status, ingest date)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import digest, stored_digest_name
from strata.schemas import STATUS_NEW

DEFAULT_DATASOURCE = "raw-files"


def ingest_time(ingest_ts: _dt.datetime | str | None = None) -> Column:
    """One instant per query: ``current_timestamp()`` or a fixed literal.

    A fixed instant makes runs reproducible; a string is read in the session
    time zone, as ``current_timestamp()`` is rendered in it.
    """
    if ingest_ts is None:
        return F.current_timestamp()
    if isinstance(ingest_ts, str):
        ingest_ts = _dt.datetime.fromisoformat(ingest_ts)
    return F.lit(ingest_ts)


def with_stored_digest(bronze: DataFrame, key: str = "movie") -> DataFrame:
    """Add ``<key>_digest`` (64-bit xxhash of the record text) before ``p_ingestdate``.

    Merges find touched partitions from this 8-byte column instead of reading
    and hashing the text column of the whole table.
    """
    name = stored_digest_name(key)
    cols = [c for c in bronze.columns if c != "p_ingestdate"]
    return bronze.select(*cols, digest(key).alias(name), "p_ingestdate")


def ingest_metadata(raw: DataFrame, datasource: str = DEFAULT_DATASOURCE,
                    ingest_ts: _dt.datetime | str | None = None,
                    key: str = "movie") -> DataFrame:
    """Stamp raw records: ``datasource, ingesttime, status, <key>, p_ingestdate``.

    ``p_ingestdate`` is the date of ``ingesttime`` in the session time zone, so
    both come from the same instant. Pure projection: no shuffle, stays in one
    codegen stage with the scan.
    """
    ts = ingest_time(ingest_ts)
    return raw.select(
        F.lit(datasource).alias("datasource"),
        ts.alias("ingesttime"),
        F.lit(STATUS_NEW).alias("status"),
        F.col(key),
        ts.cast("date").alias("p_ingestdate"),
    )
