"""Prepare activity data, take the next batch, land it and drain it.

The landing table is the backlog. A batch is the first ``10 * hours`` rows in
``(month, day, hour)`` order, made total by a unique tie-breaker; it is written
once as JSON lines, read back, and exactly the rows written are deleted from
the backlog by ``name``, ``time`` and the tie-breaker, NULL equal to NULL.
Landing every batch until the backlog is empty returns each backlog row exactly
once, whatever its name and time. ``land_next_batches`` lands many batches in one
pass, with one delete: a backlog of n batches isn't rewritten n times.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.functions.activity import with_time_parts
from strata.operators.merge import merge_delete_path, partition_predicate
from strata.schemas import LANDING_DELETE_KEY, LANDING_ORDER, LANDING_ROWS_PER_HOUR
from strata.session import fresh_dir
from strata.sinks.staging import stage
from strata.sinks.writers import write_json_lines, write_new

#: Partition column of the folders of batches that are landed together.
BATCH = "batch"
#: Landed rows up to which the delete broadcasts their keys without asking their size.
FEW_ROWS = 100_000


def prepare_activity(df: DataFrame, time_col: str = "time", tz: str | None = None) -> DataFrame:
    """C5 transform: ``time`` (epoch seconds) to text, plus ``day, month, hour``."""
    return with_time_parts(df, time_col, tz)


def prepare_activity_path(spark: SparkSession, df: DataFrame, landing_path: str,
                          time_col: str = "time", tz: str | None = None,
                          partition_by: Sequence[str] = ("month", "day"),
                          cluster_by: Sequence[str] | None = ("hour",),
                          tie_breaker: str | Sequence[str] = ()) -> None:
    """Write the prepared backlog (fails if it exists).

    Partitioning by ``month, day`` keeps each later batch delete inside the
    one or two earliest partitions instead of rewriting the whole backlog.
    With ``cluster_by`` the rows are range-partitioned on the partition
    columns plus these columns first, so each task holds a contiguous time
    range and writes into one or two partition directories (no tasks x days
    small files). A hot day is spread over several tasks, since the range
    bounds also cut on the extra columns; with a ``tie_breaker`` a hot second is too.
    Inside a task the rows are sorted by the landing order, so that the row
    groups a cursor has passed are skipped by their statistics.
    """
    out = prepare_activity(df, time_col, tz)
    if partition_by and cluster_by is not None:
        tie = _tie_breaker(tie_breaker)
        out = out.repartitionByRange(*partition_by, *cluster_by, time_col, *tie).sortWithinPartitions(
            *partition_by, *cluster_by, *tie)
    write_new(out, landing_path, partition_by=partition_by)


def _tie_breaker(tie_breaker: str | Sequence[str]) -> list[str]:
    return [tie_breaker] if isinstance(tie_breaker, str) else list(tie_breaker)


def next_batch(landing: DataFrame, hours: int = 1, tie_breaker: str | Sequence[str] = (),
               order: Sequence[str] = LANDING_ORDER,
               rows_per_hour: int = LANDING_ROWS_PER_HOUR) -> DataFrame:
    """O1: the first ``rows_per_hour * hours`` rows by ``order`` + tie-breaker.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top n, so
    memory is bounded by n per task, whatever the backlog size.
    """
    tb = _tie_breaker(tie_breaker)
    n = rows_per_hour * hours
    return landing.orderBy(*[F.col(c).asc() for c in list(order) + tb]).limit(n)


def leading_partitions(landing: DataFrame, partition_by: Sequence[str], n: int) -> list:
    """Partition value rows, in order, that together hold the first ``n`` rows."""
    parts = list(partition_by)
    keep, total = [], 0
    # every partition holds a row, so the first n partitions are enough
    for row in landing.groupBy(*parts).count().orderBy(*parts).limit(n).collect():
        keep.append(row)
        total += row["count"]
        if total >= n:
            break
    return keep


def read_backlog(spark: SparkSession, landing_path: str,
                 partition_by: Sequence[str] = ("month", "day")) -> DataFrame | None:
    """The backlog, or ``None`` once every partition has been drained.

    The partition columns are read as ``INT``, not inferred: a backlog of which
    only the NULL partition is left has nothing to infer from.
    """
    try:
        data = spark.read.option("recursiveFileLookup", True).parquet(landing_path).schema
        parts = [StructField(c, IntegerType()) for c in partition_by]
        return spark.read.schema(StructType([*data.fields, *parts])).parquet(landing_path)
    except AnalysisException as exc:
        if "UNABLE_TO_INFER_SCHEMA" in str(exc) or "PATH_NOT_FOUND" in str(exc):
            return None
        raise


def land_next_batch(spark: SparkSession, landing_path: str, raw_dir: str, hours: int = 1,
                    tie_breaker: str | Sequence[str] = (),
                    delete_key: Sequence[str] = LANDING_DELETE_KEY,
                    partition_by: Sequence[str] = ("month", "day"),
                    batch_name: str | None = None,
                    rows_per_hour: int = LANDING_ROWS_PER_HOUR) -> str | None:
    """C4: move the next batch from the backlog to ``raw_dir`` as JSON lines.

    Returns the batch folder, or ``None`` when the backlog is empty. The batch
    is evaluated once: the delete uses the rows read back from the written
    folder, never a second evaluation of the lazy top-n. ``tie_breaker`` must
    make rows of one ``(month, day, hour)`` distinct; it is part of the delete
    key, so rows that share ``name`` and ``time`` stay until they are landed.
    """
    tb = _tie_breaker(tie_breaker)
    if not tb:
        raise ValueError("landing needs a tie_breaker that is unique in the backlog")
    landing = read_backlog(spark, landing_path, partition_by)
    if landing is None:
        return None
    n = rows_per_hour * hours
    scope, keep = landing, None
    if partition_by and list(partition_by) == list(LANDING_ORDER)[:len(partition_by)]:
        # partitions are the leading order columns: prune to the first ones
        keep = leading_partitions(landing, partition_by, n)
        if not keep:
            return None
        scope = landing.where(partition_predicate(partition_by, keep))
    batch = next_batch(scope, hours, tie_breaker, rows_per_hour=rows_per_hour)
    out = f"{raw_dir.rstrip('/')}/{batch_name}" if batch_name else fresh_dir(spark, "batch")
    write_json_lines(batch, out)
    written = spark.read.schema(landing.schema).json(out)
    # the batch has at most n rows, and month/day are functions of `time`
    time_keyed = "time" in delete_key and set(partition_by) <= {"month", "day", "hour"}
    # the batch came from the `keep` partitions, and a time key stays in its
    # partition, so `keep` is a superset of the partitions the delete touches
    merge_delete_path(spark, landing_path, written, [*delete_key, *tb], partition_by=partition_by,
                      null_safe=True, schema=landing.schema,
                      keys_row_bound=rows_per_hour * hours, partitions_from_keys=time_keyed,
                      keys_are_files=True,
                      touched_partitions=[{c: r[c] for c in partition_by} for r in keep]
                      if (keep and time_keyed) else None)
    return out


def numbered(spark: SparkSession, rows: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, int]:
    """Staged ``rows`` with ``name``, each row's place (from 0) by ``order``, NULLs first; and how many there are.

    The rows are staged in ranges of ``order``, sorted inside, with an id that
    holds the range and the place in it; the counts of the ranges (one number
    each) give the rows before it.
    """
    by, row, part = [F.col(c).asc() for c in order], "__row", "__range"
    ranged = stage(spark, rows.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn(row, F.monotonically_increasing_id()), "numbered")
    ranged = ranged.withColumn(part, F.shiftright(row, 33))
    counts = ranged.groupBy(part).count().orderBy(part).collect()
    ends = list(accumulate(r["count"] for r in counts))
    before = spark.createDataFrame([(r[part], end - r["count"]) for r, end in zip(counts, ends, strict=True)],
                                   f"{part} BIGINT, __before BIGINT")
    place = F.col("__before") + F.col(row).bitwiseAND((1 << 33) - 1)
    return (ranged.join(F.broadcast(before), part).withColumn(name, place).drop(row, part, "__before"),
            ends[-1] if ends else 0)


def land_next_batches(spark: SparkSession, landing_path: str, raw_dir: str, hours: int = 1,
                      tie_breaker: str | Sequence[str] = (), first: int = 1, most: int | None = None,
                      delete_key: Sequence[str] = LANDING_DELETE_KEY,
                      partition_by: Sequence[str] = ("month", "day"),
                      rows_per_hour: int = LANDING_ROWS_PER_HOUR) -> list[str]:
    """C4 for the next batches together: the folders that ``land_next_batch`` would fill one after the other.

    All of the backlog's batches, or ``most`` of them; an empty list when the
    backlog is empty. Each row's place in the total order gives its batch; one
    job writes every batch as JSON lines to a folder of its own,
    ``<raw_dir>/batch=<number>``, numbered from ``first`` (``raw_dir`` holds
    nothing else). Then exactly the rows read back from these folders are
    deleted, all at once: a sort and a rewrite of the partitions that the
    batches come from, however many they are. A run that dies before the delete
    and is repeated with the same ``first`` replaces its folders.
    """
    tb = _tie_breaker(tie_breaker)
    if not tb:
        raise ValueError("landing needs a tie_breaker that is unique in the backlog")
    landing = read_backlog(spark, landing_path, partition_by)
    if landing is None:
        return []
    n = rows_per_hour * hours
    scope, keep = landing, None
    if most is not None and partition_by and list(partition_by) == list(LANDING_ORDER)[:len(partition_by)]:
        keep = leading_partitions(landing, partition_by, n * most)
        scope = landing.where(partition_predicate(partition_by, keep))
    elif partition_by:
        keep = landing.select(*partition_by).distinct().collect()  # partition values only
    placed, total = numbered(spark, scope, [*LANDING_ORDER, *tb], "__place")
    if most is not None:
        total = min(total, n * most)
    if not total:
        return []
    last = first + -(-total // n) - 1
    number = (F.floor(F.col("__place") / n) + first).cast("int")
    (placed.where(F.col("__place") < total).withColumn(BATCH, number).drop("__place")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).json(raw_dir))
    written = (spark.read.schema(StructType([*landing.schema.fields, StructField(BATCH, IntegerType())])).json(raw_dir)
               .where(F.col(BATCH).between(first, last)).drop(BATCH))
    # as in land_next_batch; many keys are joined by a shuffle
    time_keyed = "time" in delete_key and set(partition_by) <= {"month", "day", "hour"}
    merge_delete_path(spark, landing_path, written, [*delete_key, *tb], partition_by=partition_by,
                      null_safe=True, schema=landing.schema, max_broadcast_rows=FEW_ROWS, keys_row_bound=total,
                      partitions_from_keys=time_keyed, keys_are_files=True,
                      touched_partitions=[{c: r[c] for c in partition_by} for r in keep]
                      if (keep and time_keyed) else None)
    return [f"{raw_dir.rstrip('/')}/{BATCH}={i}" for i in range(first, last + 1)]
