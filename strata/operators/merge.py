"""Key-based MERGE (update matched, delete matched) without row-level tables.

Two layers:

* pure DataFrame functions, ``merge_update`` / ``merge_delete``: the new
  content of the target, as a plan (this is what the oracle checks);
* ``merge_update_path`` / ``merge_delete_path``: copy-on-write application
  to a partitioned file table. Only partitions holding a matched row are
  rewritten: keys are staged, the touched partition values are found with a
  semi join and staged, and the touched partitions are re-derived and written
  back with a dynamic partition overwrite, whose files are swapped in at job
  commit. Never a static overwrite of the path being read.

A NULL key never matches. Every target row carrying a matched key changes,
whatever its other columns. Long text keys are joined on a 64-bit digest plus
the exact text, so the sort prefix is discriminative and a digest collision
cannot match.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.keys import DIGEST, bloom_options, digest, stored_digest_name
from strata.operators.joins import broadcast_if_small, size_at_most
from strata.sinks.files import path_exists, remove_path
from strata.sinks.staging import stage

_HIT = "__hit"
_SET = "__set_"
SetValues = Mapping[str, "str | Column"]


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _use_digest(df: DataFrame, on: list[str]) -> bool:
    return len(on) == 1 and isinstance(df.schema[on[0]].dataType, StringType)


def _with_digest(df: DataFrame, on: list[str], use: bool) -> DataFrame:
    """Add the join digest; a stored ``<key>_digest`` column is reused, not recomputed."""
    if not use:
        return df
    stored = stored_digest_name(on[0])
    if stored in df.columns:
        return df.withColumn(DIGEST, F.col(stored))
    return df.withColumn(DIGEST, digest(*on))


def _join_cols(on: list[str], use: bool) -> list[str]:
    return ([DIGEST] if use else []) + on


def _value(v: str | Column) -> Column:
    return F.col(v) if isinstance(v, str) else v


def merge_source(source: DataFrame, on: str | Sequence[str], set_values: SetValues,
                 use_digest: bool | None = None, dedupe: bool = True, by_key: bool = False) -> DataFrame:
    """Source rows reduced to distinct ``(key, new values)`` with non-NULL keys.

    De-duplication is a partial + final aggregate, so repeated keys collapse
    before the shuffle. Two *different* values for one key would make the
    merge ambiguous; ``assert_unambiguous`` checks that on a staged source.
    ``by_key``: the values are a function of the key, so the rows are grouped by the
    key alone, and the join that follows needs no second shuffle of them.
    """
    keys = _keys(on)
    use = _use_digest(source, keys) if use_digest is None else use_digest
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    src = source.where(present).select(
        *keys, *[_value(v).alias(_SET + c) for c, v in set_values.items()])
    src = _with_digest(src, keys, use)
    if dedupe and by_key:
        jc = _join_cols(keys, use)
        return src.groupBy(*jc).agg(*[F.max(_SET + c).alias(_SET + c) for c in set_values]).select(*src.columns)
    return src.dropDuplicates() if dedupe else src


def assert_unambiguous(keys: DataFrame, on: str | Sequence[str]) -> None:
    """Raise when one key carries two different sets of values."""
    k = _keys(on)
    bad = keys.groupBy(*k).count().where(F.col("count") > 1).limit(1).count()
    if bad:
        raise ValueError("merge source gives two different updates for one key")


def merge_update(target: DataFrame, source: DataFrame, on: str | Sequence[str],
                 set_values: SetValues, broadcast_source: bool = False,
                 prepared: bool = False) -> DataFrame:
    """J2 (pure): target with ``set_values`` applied to rows whose key matches.

    Update only: no row is inserted or deleted, so the row count is kept.
    ``set_values`` maps target columns to source columns or expressions over
    the source. Pass ``prepared=True`` when ``source`` already is the output
    of :func:`merge_source`.
    """
    keys = _keys(on)
    use = _use_digest(target, keys)
    src = source if prepared else merge_source(source, keys, set_values, use)
    src = src.withColumn(_HIT, F.lit(True))
    if broadcast_source:
        src = F.broadcast(src)
    t = _with_digest(target, keys, use)
    j = t.join(src, _join_cols(keys, use), "left")
    return j.select(*[
        F.when(F.col(_HIT), F.col(_SET + c)).otherwise(F.col(c)).alias(c)
        if c in set_values else F.col(c)
        for c in target.columns
    ])


def merge_delete(target: DataFrame, keys: DataFrame, on: str | Sequence[str],
                 broadcast_keys: bool = False, null_safe: bool = False) -> DataFrame:
    """J3 (pure): target rows whose key is not among ``keys`` (left anti join).

    NULL keys never match, so target rows with a NULL key part are kept;
    with ``null_safe`` NULL equals NULL.
    """
    k = _keys(on)
    src = keys.select(*k)
    if broadcast_keys:
        src = F.broadcast(src)
    if null_safe:
        return null_safe_join(target, src, k, "left_anti").select(*target.columns)
    return target.join(src, k, "left_anti").select(*target.columns)


# --- copy-on-write application to a file table -------------------------------

_stage = stage


def partition_predicate(partition_by: Sequence[str], rows) -> Column:
    """A predicate over partition columns only, true for the given value rows.

    Being over partition columns only, it is applied to the file index at
    planning time (``PartitionFilters``): unlisted partitions are never read.
    """
    if not rows:
        return F.lit(False)
    return partition_text(partition_by).isin([row_text(partition_by, r) for r in rows])


_NULL, _SEP = "\u0002", "\u0001"


def partition_text(partition_by: Sequence[str]) -> Column:
    """The partition values of a row as one text, NULL included (never NULL itself)."""
    return F.concat_ws(_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in partition_by])


def partition_value(text: str) -> str | None:
    """The value that ``partition_text`` of a single column stands for."""
    return None if text == _NULL else text


def _value_text(v) -> str | None:
    if v is None:
        return None
    return str(v).lower() if isinstance(v, bool) else str(v)


def row_text(partition_by: Sequence[str], row) -> str:
    """``partition_text`` of collected partition values."""
    texts = [_value_text(row[c]) for c in partition_by]
    return _SEP.join(_NULL if t is None else t for t in texts)


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which NULL equals NULL; the columns of ``left``."""
    renamed = right.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(on)])
    match = F.lit(True)
    for i, c in enumerate(on):
        match = match & F.col(c).eqNullSafe(F.col(f"__on{i}"))
    return left.join(renamed, match, how)


def _refuse_stream_sink(spark: SparkSession, path: str) -> None:
    """A folder written by the file stream sink is read through its log, not its files."""
    if path_exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{path} holds a file sink's log (_spark_metadata): a rewrite would make it unreadable")


#: Keys up to which the probe asks for each digest by itself.
PROBE_KEYS = 1000
#: Values of one pushed IN; beyond this Spark pushes only the smallest and the largest.
_IN = 10


def digest_filter(column: str, values: Sequence[int]) -> Column:
    """``column`` is one of ``values``, in a form that reaches the Parquet scan value by value.

    Each value is then looked up in a row group's statistics and Bloom filter.
    """
    parts = [F.col(column).isin(list(values[i:i + _IN])) for i in range(0, len(values), _IN)]
    while len(parts) > 1:  # a balanced tree of ORs
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2:]
    return parts[0] if parts else F.lit(False)


def _probe(target: DataFrame, keys: DataFrame, on: list[str], partition_by: list[str]) -> DataFrame | None:
    """Partition values of rows whose stored digest is a key's, for few keys; ``None`` otherwise."""
    stored = stored_digest_name(on[0])
    if len(on) != 1 or stored not in target.columns or DIGEST not in keys.columns:
        return None
    found = [r[0] for r in keys.select(DIGEST).distinct().limit(PROBE_KEYS + 1).collect()]
    if len(found) > PROBE_KEYS:
        return None
    return target.where(digest_filter(stored, found)).select(*partition_by)


def _touched_scope(spark: SparkSession, target: DataFrame, keys: DataFrame,
                   join_cols: list[str], partition_by: list[str],
                   null_safe: bool = False, probe_first: Sequence[str] = ()) -> tuple[list, DataFrame]:
    """``(touched, scope)``: partition values holding a matched row, and the target pruned to them.

    With a digest among the join columns, the touched partitions are found
    by the digest alone: a collision can only add a partition to rewrite,
    never miss one (the rewrite still matches digest and text). When the
    target stores the digest (``<key>_digest``) this scan reads 8 bytes per
    row instead of the text column, and with few keys (``PROBE_KEYS``) only the
    row groups that may hold one of them.

    The touched values are staged and read back: one row per partition
    directory at most, a list that the driver's file index holds anyway. They
    become a static partition filter, pruned at planning time.
    """
    probe = [DIGEST] if DIGEST in join_cols else join_cols
    hits = _probe(target, keys, list(probe_first), partition_by) if probe_first else None
    if hits is None and null_safe:
        hits = null_safe_join(target, keys, probe, "left_semi")
    elif hits is None:
        hits = target.join(keys.select(*probe), probe, "left_semi")
    touched = _stage(spark, hits.select(*partition_by).distinct(), "merge-touched").collect()
    return touched, target.where(partition_predicate(partition_by, touched))


def _write_back(spark: SparkSession, rows: DataFrame, path: str, fmt: str,
                partition_by: list[str], sort_within: Sequence[str] = (), key: str | None = None) -> None:
    """Replace the partitions present in ``rows`` (or, unpartitioned, the table).

    A dynamic partition overwrite writes every task's files to a job staging
    folder and swaps the partition directories in only at job commit, after
    all reads are done, so ``rows`` may read the target itself; a retried
    task re-reads intact inputs. A static overwrite deletes the target
    first, so an unpartitioned rewrite is staged before it.

    ``sort_within`` adds a task-local sort (no shuffle; the partitioned writer
    sorts by the partition columns anyway) so that Parquet row groups hold
    few distinct values of these columns and later equality scans on them
    skip row groups by their statistics. A stored digest of ``key`` is the last
    column of that sort and gets Bloom filters.
    """
    if not partition_by:
        rows = _stage(spark, rows, "rewrite")
    options = bloom_options(rows.columns, key) if key and fmt == "parquet" else {}
    order = [*sort_within, *([stored_digest_name(key)] if options else [])]
    if order:
        rows = rows.sortWithinPartitions(*partition_by, *order)
    w = rows.write.format(fmt).options(**options).mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.save(path)


def merge_update_path(spark: SparkSession, path: str, source: DataFrame,
                      on: str | Sequence[str], set_values: SetValues,
                      partition_by: Sequence[str] = ("p_ingestdate",), fmt: str = "parquet",
                      max_broadcast_rows: int = 2_000_000,
                      check_unambiguous: bool = True,
                      max_broadcast_bytes: int = 128 * 1024 * 1024,
                      target_filter: Column | None = None,
                      source_is_stable: bool = False,
                      sort_within: Sequence[str] = (),
                      source_bound: tuple[int, int] | None = None) -> None:
    """J2 applied to the table at ``path`` (copy-on-write, touched partitions only).

    The source is staged first, so a source that reads the target itself is
    evaluated exactly once, before the target changes. Pass
    ``check_unambiguous=False`` when the new values are a function of the key
    (e.g. a status derived from the record text), which makes a conflict
    impossible and saves one aggregation.

    ``target_filter`` (a predicate on partition columns, e.g. recent ingest
    dates) narrows the rows the merge may touch; it is pruned at the scan.
    It changes the semantics (rows outside it are never updated), so it is
    opt-in. ``source_is_stable``: the source reads files this merge does not
    rewrite (e.g. a staged batch), so its keys are not staged again; the
    broadcast check then runs on the source before de-duplication, an upper
    bound of the keys. ``source_bound``: ``(rows, bytes)`` of the source
    before de-duplication, already measured (e.g. observed while staging
    it), in the byte terms of ``size_at_most``; it replaces the checking
    pass. ``sort_within``: columns to cluster rewritten partitions by (e.g.
    ``status``), see ``_write_back``.
    """
    keys = _keys(on)
    parts = list(partition_by)
    _refuse_stream_sink(spark, path)
    full = spark.read.format(fmt).load(path)
    target = full.where(target_filter) if target_filter is not None else full
    use = _use_digest(target, keys)
    if source_is_stable:
        # the touched partitions need no distinct keys, and of a text its digest only
        probe = merge_source(source, keys, set_values, use, dedupe=False)
        src = merge_source(source, keys, set_values, use, by_key=not check_unambiguous)
        if source_bound is not None:
            small = source_bound[0] <= max_broadcast_rows and source_bound[1] <= max_broadcast_bytes
        else:
            small = size_at_most(probe, max_broadcast_rows, max_broadcast_bytes)
        src_b = F.broadcast(src) if small else src
        probe = src_b if small else probe
    else:
        src = _stage(spark, merge_source(source, keys, set_values, use), "merge-keys")
        src_b, small = broadcast_if_small(src, max_broadcast_rows, max_broadcast_bytes)
        probe = src_b
    if check_unambiguous:
        assert_unambiguous(src, _join_cols(keys, use))
    jc = _join_cols(keys, use)
    if parts:
        _, scope = _touched_scope(spark, _with_digest(target, keys, use), probe, jc, parts,
                                  probe_first=keys if use else ())
        scope = scope.select(*target.columns)
    else:
        scope = target
    if not parts and target_filter is not None:
        raise ValueError("target_filter needs a partitioned target")
    updated = merge_update(scope, src_b, keys, set_values, broadcast_source=small, prepared=True)
    _write_back(spark, updated.select(*target.columns), path, fmt, parts, sort_within, keys[0] if use else None)


def partition_dir(spark: SparkSession, path: str, parts: list[str], row) -> str:
    """The partition's folder as Spark names it: special characters escaped, NULL by its own name."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return path.rstrip("/") + "/" + "/".join(name(c, _value_text(row[c])) for c in parts)


def merge_delete_path(spark: SparkSession, path: str, keys: DataFrame,
                      on: str | Sequence[str], partition_by: Sequence[str] = (),
                      fmt: str = "parquet", max_broadcast_rows: int = 2_000_000,
                      keys_row_bound: int | None = None,
                      partitions_from_keys: bool = False,
                      max_broadcast_bytes: int = 128 * 1024 * 1024,
                      keys_are_files: bool = False,
                      touched_partitions: list | None = None,
                      null_safe: bool = False, schema=None) -> None:
    """J3 applied to the table at ``path``.

    Touched partitions are rewritten without the matched rows. A partition
    whose rows were all deleted receives no data from a dynamic overwrite, so
    its directory is removed explicitly (the list of such partitions is
    bounded by the touched-partition count).

    ``keys_row_bound``: a proven upper bound on the key rows (e.g. a batch of
    n rows); within ``max_broadcast_rows`` the keys are broadcast without a
    counting pass. ``partitions_from_keys``: ``keys`` carries the partition
    columns and the partition is a function of the key (e.g. day and month of
    a time key), so the touched partitions are read off the keys instead of
    a semi join over the whole target. ``keys_are_files``: ``keys`` is a plain
    read of files that nothing here rewrites, so it is not staged again.
    ``touched_partitions``: partition value mappings known to contain every
    matched row (a superset is fine: an untouched partition is rewritten
    unchanged), which replaces finding them. ``null_safe``: NULL equals NULL
    in the keys. ``schema``: the target's, partition columns included; without
    it a table left with NULL partitions only has no partition type to infer.
    """
    k = _keys(on)
    parts = list(partition_by)
    _refuse_stream_sink(spark, path)
    reader = spark.read.format(fmt)
    target = (reader.schema(schema) if schema is not None else reader).load(path)
    present = F.lit(True)
    for c in k if not null_safe else ():
        present = present & F.col(c).isNotNull()
    carry = parts if (parts and partitions_from_keys) else []
    src = keys.select(*k, *carry).where(present)
    if not keys_are_files:
        src = _stage(spark, src.distinct(), "delete-keys")
    if keys_row_bound is not None and keys_row_bound <= max_broadcast_rows:
        src_b, small = F.broadcast(src), True
    else:
        src_b, small = broadcast_if_small(src, max_broadcast_rows, max_broadcast_bytes)
    if parts and touched_partitions is not None:
        touched_rows = touched_partitions
        src_b = src_b.select(*k)
        scope = target.where(partition_predicate(parts, touched_rows))
    elif parts and partitions_from_keys:
        touched = src.select(*parts).distinct()
        src_b = src_b.select(*k)
        touched_rows = touched.collect()  # partition values only
        scope = target.where(partition_predicate(parts, touched_rows))
    elif parts:
        touched_rows, scope = _touched_scope(spark, target, src_b, k, parts, null_safe)
    else:
        scope = target
    kept = merge_delete(scope, src_b, k, broadcast_keys=small, null_safe=null_safe).select(*target.columns)
    if not parts:
        _write_back(spark, kept, path, fmt, parts)
        return
    if not touched_rows:
        return
    # touched partitions left without rows get no files from the overwrite; the
    # write itself notes which partitions still have rows
    seen = Observation(f"merge-delete-{uuid.uuid4().hex[:8]}")
    _write_back(spark, kept.observe(seen, F.collect_set(partition_text(parts)).alias("still")), path, fmt, parts)
    still = set(seen.get["still"] or ())
    for row in touched_rows:
        if row_text(parts, row) not in still:
            remove_path(spark, partition_dir(spark, path, parts, row))
