"""Bronze -> Silver with one status merge back into Bronze.

S2 -> X1 -> P3/P4 -> outcome (F4) -> stage -> K2 -> K8 -> J2 -> K8.

The record text is parsed once; the outcome column carries the split, so
clean, quarantined and unclassified rows are filters over one staged batch.
The Bronze status merge is applied once with the per-row outcome
(``loaded`` / ``quarantined``), not as two merges.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.records import parse_records, unpack
from strata.operators.merge import merge_update_path, partition_text, partition_value
from strata.operators.quality import OUTCOME, assert_schema, outcome_column
from strata.schemas import (
    BRONZE_PARTITION,
    SILVER_COLUMNS,
    SILVER_PARTITION,
    STATUS_NEW,
    UNPACKED_COLUMNS,
    silver_schema,
)
from strata.session import fresh_dir
from strata.sinks.batches import BATCH, begin, finish, pending, write_batch
from strata.sinks.catalog import register_table
from strata.sinks.staging import stage_observed
from strata.sinks.writers import append_partitioned, rebuild_partitioned
from strata.sources.tables import read_by_status

#: Name of this step in the record of an unfinished batch.
STEP = "bronze_to_silver"


def classified_batch(bronze_new: DataFrame, nulls: str = "leave") -> DataFrame:
    """The unpacked 22 columns plus ``outcome`` for a set of Bronze rows."""
    return unpack(parse_records(bronze_new)).withColumn(OUTCOME, outcome_column(nulls=nulls))


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str,
                     bronze_table: str | None = None, silver_table: str | None = None,
                     nulls: str = "leave", rebuild_silver: bool = False,
                     partition_filter: Column | None = None,
                     merge_scope: Column | None = None, profile: dict | None = None,
                     repeatable: bool = False, on_step: Callable[[str], None] | None = None) -> DataFrame:
    """C2. Returns the staged, classified batch (22 columns + ``outcome``).

    Silver rows keep the status they had when read (``new``), as the source
    pipeline does. Rows in neither class stay ``new`` in Bronze.

    ``partition_filter`` limits which new rows are read; ``merge_scope``
    limits which Bronze partitions the status merge may touch (default: all,
    as a MERGE on the record text does). ``profile``, if given, receives the
    null profile F6 of the batch (``rows``, ``complete_rows``: those without
    any NULL in the 22 columns), counted by the write that stages it.

    ``repeatable``: a run that dies midway is completed by the next repeatable
    C2 or C3 on this Silver layer, and no row is appended twice. The layer then has a second
    partition column, ``p_batch`` (see ``strata.sinks.batches``).
    ``on_step`` is called with ``staged``, ``appended`` and ``merged`` after these.
    """
    told = on_step or (lambda step: None)
    if repeatable:
        if rebuild_silver or merge_scope is not None:
            raise ValueError("a repeatable run neither rebuilds Silver nor narrows its merge")
        complete_pending(spark, bronze_path, silver_path)
    new = read_by_status(spark, bronze_path, STATUS_NEW, partition_filter=partition_filter)
    decided_row = F.col(OUTCOME) != STATUS_NEW
    staged = fresh_dir(spark, "silver-batch")
    # size of the merge source (rows, bytes of text + outcome + digest), measured by the staging write
    batch, m = stage_observed(spark, classified_batch(new, nulls), "silver-batch", {
        "all": F.count(F.lit(1)),
        "complete": F.count_if(reduce(and_, [F.col(c).isNotNull() for c in UNPACKED_COLUMNS])),
        "rows": F.count_if(decided_row),
        "bytes": F.sum(F.when(decided_row, F.coalesce(F.octet_length("movie"), F.lit(0))
                              + F.octet_length(OUTCOME) + F.lit(8)).otherwise(F.lit(0))),
        "dates": F.collect_set(F.when(F.col(OUTCOME) == "loaded", partition_text([SILVER_PARTITION]))),
    }, path=staged)
    if profile is not None:
        profile.update(rows=m["all"], complete_rows=m["complete"])
    told("staged")
    record = begin(spark, silver_path, STEP, staged, {}) if repeatable and m["rows"] else None
    _append(batch, silver_path, record["batch"] if record else None, rebuild_silver)
    told("appended")
    if silver_table:
        register_table(spark, silver_table, silver_path, partitions=written(m["dates"], record))
    _merge(spark, bronze_path, batch, source_bound=(m["rows"], m["bytes"] or 0), target_filter=merge_scope)
    told("merged")
    if record:
        finish(spark, silver_path)
    if bronze_table:
        register_table(spark, bronze_table, bronze_path, partitions=())  # a merge adds no partition
    return batch


def written(dates: list[str] | None, record: dict | None) -> list[dict]:
    """The partitions that a batch's rows went to, as the staging write saw them (one value a date)."""
    own = {BATCH: record["batch"]} if record else {}
    return [{SILVER_PARTITION: partition_value(d), **own} for d in dates or ()]


def bronze_partitions(spark: SparkSession, bronze_path: str) -> tuple[str, ...]:
    """Partition columns of a Bronze layer, a batch column included where it has one."""
    columns = spark.read.parquet(bronze_path).columns
    return (BRONZE_PARTITION, BATCH) if BATCH in columns else (BRONZE_PARTITION,)


def _append(batch: DataFrame, silver_path: str, batch_id: str | None = None, rebuild: bool = False) -> None:
    clean = batch.where(F.col(OUTCOME) == "loaded").select(*SILVER_COLUMNS)
    assert_schema(clean, silver_schema(), nullable=False)  # V2, before any write
    if batch_id:
        write_batch(clean, silver_path, SILVER_PARTITION, batch_id)
    elif rebuild:
        rebuild_partitioned(clean, silver_path, SILVER_PARTITION)
    else:
        append_partitioned(clean, silver_path, SILVER_PARTITION)


def _merge(spark: SparkSession, bronze_path: str, batch: DataFrame, **bounds) -> None:
    decided = batch.where(F.col(OUTCOME) != STATUS_NEW).select("movie", OUTCOME)
    merge_update_path(spark, bronze_path, decided, "movie", {"status": OUTCOME},
                      partition_by=bronze_partitions(spark, bronze_path), check_unambiguous=False,
                      source_is_stable=True, sort_within=("status",), **bounds)


def complete_pending(spark: SparkSession, bronze_path: str, silver_path: str) -> str | None:
    """Finish the step that died midway on this Silver layer, if one did; its name."""
    record = pending(spark, silver_path)
    if record is None:
        return None
    batch = spark.read.parquet(record["staged"])
    if record["step"] == STEP:
        _append(batch, silver_path, record["batch"])
        _merge(spark, bronze_path, batch)
    else:
        from strata.plans.silver_update import apply_repaired  # C3 builds on this module

        apply_repaired(spark, batch, bronze_path, silver_path, record["batch"], **record["settings"])
    finish(spark, silver_path)
    return record["step"]
