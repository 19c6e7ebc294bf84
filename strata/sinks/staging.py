"""Stage a plan as files under the shared scratch root (a lineage cut).

A staged frame is evaluated exactly once; everything derived from it reads
the files, so a lost executor re-reads files instead of re-running the parse,
and a source that reads a table can no longer see that table change.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from strata.session import fresh_dir


def stage(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def stage_observed(spark: SparkSession, df: DataFrame, label: str, metrics: Mapping[str, Column],
                   path: str | None = None) -> tuple[DataFrame, dict]:
    """``stage`` (to ``path``, if given) plus aggregate metrics computed by the same write job.

    ``DataFrame.observe`` evaluates the aggregates while the rows stream to
    the files, so sizes and counts of the batch cost no extra pass.
    """
    obs = Observation(f"{label}-{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    path = path or fresh_dir(spark, label)
    observed.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), dict(obs.get)
