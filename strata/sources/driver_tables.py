"""The driver's generated tables and the movie-shaped view over them.

``movie_records`` maps orders x customer x nation onto the JSON record shape
(see FIXTURES.md section C): each order is a movie, the customer gives the
title and runtime, the nation is the one genre.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.activity import epoch_seconds_of_ntz


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def movie_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record-shaped view ``m``: ``Id, Title, Budget, RunTime,
    OriginalLanguage, ReleaseDate, genres``.

    Declarative joins: the planner broadcasts the sides its size statistics
    prove small (nation always; customer at small scale) and sort-merges the
    rest, with AQE re-planning from runtime sizes.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey, "inner")
         .join(n, c.c_nationkey == n.n_nationkey, "inner"))
    return j.select(
        F.col("o_orderkey").alias("Id"),
        F.col("c_name").alias("Title"),
        (F.col("o_totalprice") * 10).alias("Budget"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("bigint"))
        .otherwise(F.col("c_acctbal").cast("bigint")).alias("RunTime"),
        F.col("c_mktsegment").alias("OriginalLanguage"),
        F.col("o_orderdate").cast("date").cast("string").alias("ReleaseDate"),
        F.array(F.struct(F.col("n_nationkey").alias("id"),
                         F.col("n_name").alias("name"))).alias("genres"),
    )


def activity_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity-shaped rows from ``events``: ``event_id, name, time, device_id``.

    ``time`` is epoch seconds of the wall-clock ``ts`` read as UTC.
    """
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("name"),
        epoch_seconds_of_ntz("ts").alias("time"),
        F.col("user_id").cast("string").alias("device_id"),
    )


def user_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 shape from ``customer``: ``user_id, device_id``."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"),
                    F.col("c_custkey").cast("string").alias("device_id"))
