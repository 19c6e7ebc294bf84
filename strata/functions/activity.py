"""Epoch seconds to a time string and its day, month and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import ACTIVITY_TIME_FORMAT

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds_of_ntz(col: str | Column) -> Column:
    """Whole seconds since the epoch of a wall-clock (NTZ) timestamp, read as UTC.

    Pure arithmetic, independent of the session time zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), c.cast("timestamp_ntz"))


def time_string(epoch: str | Column, tz: str | None = None) -> Column:
    """``from_unixtime`` (session zone) or, with ``tz``, the wall clock in ``tz``."""
    e = F.col(epoch) if isinstance(epoch, str) else epoch
    if tz is None:
        return F.from_unixtime(e, ACTIVITY_TIME_FORMAT)
    utc_wall = F.timestamp_add("SECOND", e, F.expr(_EPOCH_NTZ))
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall) if tz != "UTC" else utc_wall
    return F.date_format(local, ACTIVITY_TIME_FORMAT)


def with_time_parts(df: DataFrame, time_col: str = "time", tz: str | None = None) -> DataFrame:
    """Replace epoch ``time`` by its string form and add ``day, month, hour``.

    As in the source data model the parts are taken from the *string*, so they
    are the wall-clock parts in the same zone.
    """
    s = df.withColumn(time_col, time_string(time_col, tz))
    t = F.col(time_col)
    return s.select(
        "*",
        F.dayofmonth(t).alias("day"),
        F.month(t).alias("month"),
        F.hour(t).alias("hour"),
    )
