"""A3/A4: distinct rows and distinct by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """A3: drop exact duplicates (all columns, arrays included).

    Planned as a partial + final hash aggregate: copies of one row are merged
    before the shuffle, so a heavily repeated row costs one shuffled row per
    map task.
    """
    return df.dropDuplicates()


def distinct_by_key(df: DataFrame, key: str | Sequence[str],
                    values: Sequence[str]) -> DataFrame:
    """A4, deterministic: one row per key, each value the max over its group.

    ``dropDuplicates([key])`` keeps an arbitrary row; taking ``max`` keeps the
    result stable across runs and partitionings and is still partially
    aggregated map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])
