"""Parse raw record text into typed columns, once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.schemas import RECORD_DDL, UNPACKED_COLUMNS

_PARSED = "__parsed"


def parse_records(df: DataFrame, key: str = "movie",
                  keep: Sequence[str] = ("status", "p_ingestdate"),
                  schema: str | StructType = RECORD_DDL,
                  corrupt_column: str | None = None) -> DataFrame:
    """``from_json`` in PERMISSIVE mode, then star-expand the struct.

    Malformed text gives a row of NULLs, a bad field only that NULL, NULL text a
    NULL struct; keys are case-sensitive. With ``corrupt_column`` the raw text
    of rows that failed (fully or in one field) is kept in that column.
    Catalyst prunes the JSON schema to the fields used downstream.
    """
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    opts = {"mode": "PERMISSIVE"}
    if corrupt_column:
        st = StructType(st.fields + [StructField(corrupt_column, StringType(), True)])
        opts["columnNameOfCorruptRecord"] = corrupt_column
    cols = [key] + [c for c in keep if c in df.columns]
    return (
        df.select(*cols, F.from_json(F.col(key), st, opts).alias(_PARSED))
        .select(*cols, f"{_PARSED}.*")
    )


def unpack(parsed: DataFrame, columns: Sequence[str] = UNPACKED_COLUMNS) -> DataFrame:
    """The fixed 22-column record projection (raw text first)."""
    return parsed.select(*columns)


def transform_bronze(bronze: DataFrame, key: str = "movie",
                     dedupe: bool = True) -> DataFrame:
    """X1 + P3 + P4 + A3 as one step: parse, unpack, drop exact duplicates.

    The parsed columns depend on the record text alone, so rows are made
    distinct by text, status and date *before* the parse: a partial + final
    hash aggregate that shuffles no parsed field, and each text is parsed once.
    """
    if dedupe:
        kept = [key, *[c for c in ("status", "p_ingestdate") if c in bronze.columns]]
        bronze = bronze.select(*kept).dropDuplicates()
    return unpack(parse_records(bronze, key=key))
