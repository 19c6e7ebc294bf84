"""Shared steps: staged tables, row keys, bounded Arrow slices, fixed patterns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import fresh_dir

# A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

#: Identity of a row inside a file scan: hash of the file's path, row in the file.
FILE, ROW = "__llm_file", "__llm_row"
KEYS = (FILE, ROW)

#: Characters (bytes of UTF-8) that a Python step works on at once.
SLICE_BYTES = 2_000_000


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (a lineage cut)."""
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(spark: SparkSession, docs: DataFrame, *columns: Column, scan: bool = False) -> DataFrame:
    """``columns`` of ``docs`` with the row keys ``KEYS``, which are unique.

    A key is the place of the row in its Parquet file, so it needs no sort, no
    counter and is the same however often the scan is repeated. ``scan=True``
    promises that ``docs`` is a plain Parquet scan; any other frame is written
    to the shared folder first.
    """
    if not scan:
        docs = staged(spark, docs, "rows")
    return docs.select(
        F.xxhash64(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.row_index").alias(ROW),
        *columns,
    )


def scanned(spark: SparkSession, docs: DataFrame, scan: bool) -> DataFrame:
    """``docs`` as a plain scan: itself when it already is one, else a staged copy."""
    return docs if scan else staged(spark, docs, "rows")


def without(spark: SparkSession, docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of the scan ``docs`` whose key is not in ``dropped`` (all columns).

    ``dropped`` is a table of keys, joined by sort-merge on the (even) keys at
    every size: one plan, whose cost grows with the input and no faster.
    """
    full = keyed(spark, docs, *[F.col(f"`{c}`") for c in docs.columns], scan=True)
    return full.join(dropped.select(*KEYS).hint("merge"), list(KEYS), "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])


def word_count(text: Column) -> Column:
    """Number of words (long); null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], column: str,
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """A dense number for each distinct integer, and how many there are."""
    import pandas as pd

    codes, distinct = pd.factorize(values)
    return codes.astype(np.int64, copy=False), len(distinct)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and for each the number of its text."""
    parts = pc.split_pattern_regex(pc.fill_null(texts, ""), pattern=SPACE + "+")
    owner, flat = pc.list_parent_indices(parts), pc.list_flatten(parts)
    keep = pc.not_equal(flat, "")
    return flat.filter(keep), owner.filter(keep).to_numpy(zero_copy_only=False).astype(np.int64)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls in one run, and the places where each begins (and the last ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets.astype(np.int64) - offsets[0]


def lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.ListArray:
    """One list for each of ``n`` owners; ``owner`` ascends along ``values``."""
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.bincount(owner, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
