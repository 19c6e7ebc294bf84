"""Schemas of the layers (raw envelope, JSON record, Bronze, Silver, activity).

Fixed values: the field names, types and column orders below must equal the
reference's so that tables written by either are interchangeable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values (reference data model) -----------------------------------
# Raw envelope: one multi-line JSON document per file, each array element is
# one record kept as its JSON text.
RAW_ENVELOPE_DDL = "movie ARRAY<STRING>"

# The JSON record (19 fields, alphabetical as in the reference; the record
# text itself is carried separately in column `movie`).
RECORD_DDL = (
    "BackdropUrl STRING, Budget DOUBLE, CreatedBy STRING, CreatedDate DATE, "
    "Id BIGINT, ImdbUrl STRING, OriginalLanguage STRING, Overview STRING, "
    "PosterUrl STRING, Price DOUBLE, ReleaseDate STRING, Revenue DOUBLE, "
    "RunTime BIGINT, Tagline STRING, Title STRING, TmdbUrl STRING, "
    "UpdatedBy STRING, UpdatedDate DATE, "
    "genres ARRAY<STRUCT<id: INT, name: STRING>>"
)

# Bronze as produced by ingestion metadata, nullability included.
BRONZE_SCHEMA = StructType([
    StructField("datasource", StringType(), False),
    StructField("ingesttime", TimestampType(), False),
    StructField("status", StringType(), False),
    StructField("movie", StringType(), True),
    StructField("p_ingestdate", DateType(), False),
])

# Bronze column order on disk (the writer puts `movie` before `status`).
BRONZE_WRITE_ORDER = ["datasource", "ingesttime", "movie", "status", "p_ingestdate"]

# Silver as written: 21 columns in this order.
SILVER_COLUMNS = [
    "Id", "Title", "Overview", "Tagline", "Budget", "Revenue", "ImdbUrl",
    "TmdbUrl", "PosterUrl", "BackdropUrl", "OriginalLanguage", "ReleaseDate",
    "RunTime", "Price", "CreatedDate", "UpdatedDate", "UpdatedBy", "CreatedBy",
    "genres", "status", "p_ingestdate",
]

# The unpacked record before the Silver write keeps the raw text first.
UNPACKED_COLUMNS = ["movie"] + SILVER_COLUMNS

# Status lifecycle values.
STATUS_NEW = "new"
STATUS_LOADED = "loaded"
STATUS_QUARANTINED = "quarantined"

# Clean / quarantine thresholds.
MIN_RUNTIME_EXCLUSIVE = 0
MIN_BUDGET = 1000000

# Partition column names of the layers.
BRONZE_PARTITION = "p_ingestdate"
SILVER_PARTITION = "p_ingestdate"

# Activity landing data: time parts derived from the epoch column.
ACTIVITY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
LANDING_ORDER = ["month", "day", "hour"]
LANDING_ROWS_PER_HOUR = 10
LANDING_DELETE_KEY = ["name", "time"]
# ---------------------------------------------------------------------------


def record_schema() -> StructType:
    """The JSON record schema as a StructType."""
    return StructType.fromDDL(RECORD_DDL)


def unpacked_schema() -> StructType:
    """Schema of the 22-column unpacked record (record + lifecycle columns)."""
    rec = {f.name: f for f in record_schema().fields}
    extra = {
        "movie": StructField("movie", StringType(), True),
        "status": StructField("status", StringType(), True),
        "p_ingestdate": StructField("p_ingestdate", DateType(), True),
    }
    return StructType([rec.get(c) or extra[c] for c in UNPACKED_COLUMNS])


def silver_schema() -> StructType:
    """Schema of the 21-column Silver table (V2)."""
    u = unpacked_schema()
    return StructType([u[c] for c in SILVER_COLUMNS])
