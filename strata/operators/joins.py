"""Size-checked broadcast.

A side is broadcast only after a bounded check has proven it small, in rows
*and* bytes; beyond the bound the join is left to the planner (sort-merge
with AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 128 * 1024 * 1024
_FIXED_WIDTH = 8  # bytes charged per non-string column


def _row_bytes(df: DataFrame) -> Column:
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def size_at_most(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                 max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` of data.

    One distributed aggregate (partial per task, one row to the driver). A
    ``limit`` in front would funnel up to ``max_rows`` rows into a single
    task, so the check is meant for staged or naturally small inputs.
    """
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).collect()[0]
    return r.n <= max_rows and (r.b or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                       max_bytes: int = DEFAULT_MAX_BYTES) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when proven small, else ``(df, False)``."""
    if size_at_most(df, max_rows, max_bytes):
        return F.broadcast(df), True
    return df, False
