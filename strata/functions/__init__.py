"""Column-level building blocks (all built-in Spark functions, no UDFs)."""

from strata.functions.activity import epoch_seconds_of_ntz, time_string, with_time_parts
from strata.functions.metadata import ingest_metadata, ingest_time
from strata.functions.records import parse_records, transform_bronze, unpack

__all__ = [
    "epoch_seconds_of_ntz", "time_string", "with_time_parts",
    "ingest_metadata", "ingest_time",
    "parse_records", "transform_bronze", "unpack",
]
