"""C3 (+G1, G3): repair quarantined Bronze rows into Silver and derive dimensions.

S3 -> X1/P3/P4/A3 -> X7 -> stage -> K3 -> J2(loaded) ; G1 -> J4 -> K4 ; G3 -> K5.

Dimensions are derived from the staged repaired batch, i.e. from the rows
read *before* their status changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.records import transform_bronze
from strata.operators.dimensions import append_new_keys, genre_lookup, languages
from strata.operators.merge import merge_update_path, partition_text
from strata.operators.quality import OUTCOME, outcome_column
from strata.operators.repair import repair_abs
from strata.plans.bronze_to_silver import bronze_partitions, complete_pending, written
from strata.schemas import (
    SILVER_PARTITION,
    STATUS_LOADED,
    STATUS_QUARANTINED,
)
from strata.session import fresh_dir
from strata.sinks.batches import begin, finish, write_batch
from strata.sinks.catalog import register_table
from strata.sinks.files import path_exists
from strata.sinks.staging import stage, stage_observed
from strata.sinks.writers import append, batch_writer, overwrite
from strata.sources.tables import read_by_status

#: Name of this step in the record of an unfinished batch.
STEP = "repair_quarantined"


@dataclass
class RepairResult:
    repaired: DataFrame          # staged repaired batch (22 columns)
    genres_added: DataFrame | None
    languages: DataFrame | None


def repaired_batch(quarantined: DataFrame, recheck: bool = False) -> DataFrame:
    """Parse, de-duplicate and repair (``abs(RunTime)``) quarantined rows.

    With ``recheck`` only rows that pass the clean predicate after the repair
    are kept; the faithful default loads every repaired row.
    """
    out = repair_abs(transform_bronze(quarantined), "RunTime")
    if recheck:
        out = out.where(outcome_column() == STATUS_LOADED)
    return out


def repair_quarantined(spark: SparkSession, bronze_path: str, silver_path: str,
                       genre_path: str | None = None, language_path: str | None = None,
                       bronze_table: str | None = None, silver_table: str | None = None,
                       genre_table: str | None = None, language_table: str | None = None,
                       recheck: bool = False, distinct_languages: bool = False,
                       partition_filter: Column | None = None,
                       merge_scope: Column | None = None, repeatable: bool = False,
                       on_step: Callable[[str], None] | None = None) -> RepairResult:
    """C3 with the dimension tables of G1 and G3.

    ``partition_filter`` limits which quarantined rows are read; ``merge_scope``
    limits which Bronze partitions the status merge may touch, as in C2;
    ``repeatable`` and ``on_step`` as in C2 (the dimensions of a run that died
    are completed too).
    """
    told = on_step or (lambda step: None)
    if repeatable:
        if merge_scope is not None:
            raise ValueError("a repeatable run doesn't narrow its merge")
        complete_pending(spark, bronze_path, silver_path)
    q = read_by_status(spark, bronze_path, STATUS_QUARANTINED, partition_filter=partition_filter)
    staged = fresh_dir(spark, "repair-batch")
    # merge source size (rows, bytes of text + "loaded" + digest), measured by the staging write
    batch, m = stage_observed(spark, repaired_batch(q, recheck), "repair-batch", {
        "rows": F.count(F.lit(1)),
        "bytes": F.sum(F.coalesce(F.octet_length("movie"), F.lit(0))
                       + F.lit(len(STATUS_LOADED) + 8)),
        "dates": F.collect_set(partition_text([SILVER_PARTITION])),
    }, path=staged)
    told("staged")
    record = None
    if repeatable and m["rows"]:
        record = begin(spark, silver_path, STEP, staged, {
            "genre_path": genre_path, "language_path": language_path, "distinct_languages": distinct_languages})
    added, langs = apply_repaired(
        spark, batch, bronze_path, silver_path, record["batch"] if record else None, genre_path, language_path,
        distinct_languages, told, source_bound=(m["rows"], m["bytes"] or 0), target_filter=merge_scope)
    if record:
        finish(spark, silver_path)
    if silver_table:
        register_table(spark, silver_table, silver_path, partitions=written(m["dates"], record))
    if bronze_table:
        register_table(spark, bronze_table, bronze_path, partitions=())  # a merge adds no partition
    for name, path in ((genre_table, genre_path), (language_table, language_path)):
        if name and path:
            register_table(spark, name, path, partitioned=False)
    return RepairResult(batch, added, langs)


def apply_repaired(spark: SparkSession, batch: DataFrame, bronze_path: str, silver_path: str,
                   batch_id: str | None = None, genre_path: str | None = None, language_path: str | None = None,
                   distinct_languages: bool = False,
                   told: Callable[[str], None] = lambda step: None, **bounds) -> tuple[DataFrame | None, DataFrame | None]:
    """Write a staged repaired batch: Silver rows, Bronze statuses, dimensions (``(genres added, languages)``).

    With a ``batch_id`` all of it may be done again: the Silver rows replace
    their own batch, and the dimensions take in only what they lack.
    """
    if batch_id:
        write_batch(batch.drop("movie"), silver_path, SILVER_PARTITION, batch_id)
    else:
        batch_writer(batch, SILVER_PARTITION, exclude_columns=["movie"]).save(silver_path)
    told("appended")
    merge_update_path(spark, bronze_path, batch.select("movie"), "movie",
                      {"status": F.lit(STATUS_LOADED)}, partition_by=bronze_partitions(spark, bronze_path),
                      check_unambiguous=False,
                      source_is_stable=True, sort_within=("status",), **bounds)
    told("merged")
    added = langs = None
    if genre_path:
        existing = spark.read.parquet(genre_path) if path_exists(spark, genre_path) else None
        added = append_new_keys(genre_lookup(batch), existing, "genre_id")
        added = stage(spark, added, "genre-new")
        append(added, genre_path)
    if language_path:
        langs = languages(batch, distinct=distinct_languages)
        overwrite(langs, language_path)
    return added, langs


__all__ = ["RepairResult", "repair_quarantined", "repaired_batch", "OUTCOME"]
