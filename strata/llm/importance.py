"""Importance resampling towards a target distribution of hashed n-grams.

Features are the runs of 1 to ``size`` consecutive words of a text, joined by a
space, each hashed into a bucket. A bucket's gain is the scaled logarithm of how
much more frequent it is in the target than in the corpus; a document's weight
is the floored mean of its features' gains, and its score adds Gumbel noise
drawn from its id. The documents of the highest scores are the draw.

Method. Array-scored weights: the gains are one array (``buckets`` numbers, a
parameter), and a slice of documents is scored by one take over its buckets and
one sum for each document. Quantile-sketch bracketing: a sketch of the scores
gives a bracket around the cutoff's place; exact counts above and inside it
show whether the cutoff lies in it, and else it is widened and counted again.
Only the bracket is sorted to find the cutoff, a (score, id) pair.

Spread: one pass over the texts, which leaves packed bucket numbers; counting
and scoring read those. No text is shuffled. Bucket counts are added up in each task
first. Ranks come from a range partitioning by (score, id): the
sizes of the ranges give the first rank of each, so no task sees all rows.

Defined cases: a null or empty text, or one without a word, has no features,
weight 0 and still a score; a null id is hashed as the empty text and comes
last among equal scores; repeated rows are drawn each; rows alike in score, id
and features are ranked in any order, as they are equal; empty tables draw
nothing; an empty target is one without features. Further columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import flat_bytes, slices, staged

#: Relative rank error that the sketch of the scores is asked for.
SKETCH_ERROR = 1e-4

# The bytes that words are made of once A-Z are lower-cased (all but
# \x00-\x2F, \x3A-\x60, \x7B-\x7F).
_WORD = np.ones(256, bool)
_WORD[0x00:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def words_of_bytes(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, lower-cased, and the number of each one's text."""
    data, offsets = flat_bytes(pc.fill_null(texts, ""))
    data = _LOWER[data]
    inside = _WORD[data]
    # a word begins where a word byte follows another byte or a text's begin
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    start = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, start, side="right") - 1
    place = np.append(0, np.cumsum(inside))
    words = pa.Array.from_buffers(pa.binary(), len(start), [
        None, pa.py_buffer(np.append(place[start], place[-1]).astype(np.int32)), pa.py_buffer(data[inside])])
    return words, owner


def feature_buckets(texts: pa.Array, buckets: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature of the texts, and the number of its text (ascending)."""
    words, owner = words_of_bytes(texts)
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy()
    found = [np.array([zlib.crc32(w) % buckets for w in distinct], np.int64)[code] if len(code) else code.astype(np.int64)]
    owners, run, names = [owner], code.astype(np.int64), distinct
    for n in range(2, size + 1):
        # a run of n words is a run of n - 1 and one more word of the same text
        if len(owner) < n:
            break
        pair = run[:-1] * len(distinct) + code[n - 1:]
        kinds, run = np.unique(pair, return_inverse=True)
        names = [names[p // len(distinct)] + b" " + distinct[p % len(distinct)] for p in kinds.tolist()]
        same = owner[:len(run)] == owner[n - 1:]
        found.append(np.array([zlib.crc32(w) % buckets for w in names], np.int64)[run][same])
        owners.append(owner[:len(run)][same])
    all_owners = np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    return np.concatenate(found)[order], all_owners[order]


def _packer(buckets: int, size: int) -> Callable:
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, owner = feature_buckets(batch.column("text"), buckets, size)
            n = np.bincount(owner, minlength=batch.num_rows)
            ends = np.append(0, np.cumsum(n * kind.itemsize)).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(ends), pa.py_buffer(found.astype(kind))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), packed],
                                             names=["id", "n_features", "packed"])

    return pack


def hashed(spark: SparkSession, rows: DataFrame, text: str, key: str | None, buckets: int, size: int) -> DataFrame:
    """Staged ``(id, n_features, packed)``: the bucket numbers of every row's features."""
    ids = F.col(f"`{key}`").cast("long") if key else F.lit(None).cast("long")
    plain = rows.select(ids.alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return staged(spark, plain.mapInArrow(_packer(buckets, size), "id long, n_features long, packed binary"),
                  "features")


def _unpacked(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat_bytes(batch.column("packed"))
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    return np.frombuffer(data.tobytes(), kind), offsets // kind.itemsize


def _counter(buckets: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "packed"):
            total += np.bincount(_unpacked(batch, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return count


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs (``buckets`` numbers)."""
    parts = features.select("packed").mapInArrow(_counter(buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the corpus."""
    buckets = len(corpus)
    s_all, t_all = float(int(corpus.sum()) + buckets), float(int(target.sum()) + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _scorer(gain: np.ndarray) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            found, offsets = _unpacked(batch, len(gain))
            total = np.append(0, np.cumsum(gain[found]))[offsets]
            n = np.diff(offsets)
            weight = np.where(n > 0, np.diff(total) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_features"), pa.array(weight)],
                                             names=["id", "n_features", "weight"])

    return score


def noise(key: Column, seed: str) -> Column:
    """Scaled Gumbel noise of an id: ``floor(-1000 * ln(-ln(u)))``, u from the id's hash."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(spark: SparkSession, docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id",
           target_text: str = "text", buckets: int = 10_000, size: int = 1, seed: str = "2024:") -> DataFrame:
    """Staged ``(id, n_features, weight, score)`` of every document."""
    features = hashed(spark, docs, text, key, buckets, size)
    wanted = hashed(spark, target, target_text, None, buckets, size)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    weights = features.mapInArrow(_scorer(gain), "id long, n_features long, weight long")
    return staged(spark, weights.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")


# --- the draw ---------------------------------------------------------------

#: The order of a draw: highest scores, then smallest ids (nulls last).
ORDER = (F.desc, "score"), (F.asc_nulls_last, "id"), (F.asc, "n_features"), (F.asc, "weight")


def _order() -> list[Column]:
    return [way(c) for way, c in ORDER]


def ranked(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first in the draw's order; no task sees all rows.

    The rows are staged in ranges of the order. The ranges' sizes (one number
    each) give the first rank of every range; inside a range the rank is a row number.
    """
    from pyspark.sql import Window

    ranges = staged(spark, rows.repartitionByRange(*_order()).withColumn("range", F.spark_partition_id()), "ranges")
    before, start = [], 0
    for r in ranges.groupBy("range").count().orderBy("range").collect():  # one row a partition
        before.append((r["range"], start))
        start += r["count"]
    first = spark.createDataFrame(before, "range int, before long")
    place = F.row_number().over(Window.partitionBy("range").orderBy(*_order()))
    return ranges.join(F.broadcast(first), "range").select(
        *rows.columns, (F.col("before") + place).cast("long").alias("rank"))


def bracket(able: DataFrame, n: int, wanted: int, error: float = SKETCH_ERROR) -> tuple[int, int, int]:
    """``(low, high, above)``: the ``wanted``-th highest of ``n`` scores lies in [low, high].

    ``above`` is the exact number of scores over ``high``. A sketch of relative
    rank error ``error`` proposes the bracket; the exact counts outside decide,
    and a bracket that misses is widened (to all scores in the end).
    """
    place, width = 1 - wanted / n, 2 * error
    while True:
        low_at, high_at = max(0.0, place - width), min(1.0, place + width)
        accuracy = int(min(1 / error, 2**31 - 1))
        sketch = able.agg(F.percentile_approx("score", [low_at, high_at], accuracy).alias("q"),
                          F.min("score").alias("least"), F.max("score").alias("most")).collect()[0]
        low = sketch.least if low_at == 0 else sketch.q[0]
        high = sketch.most if high_at == 1 else sketch.q[1]
        outside = able.agg(F.count_if(F.col("score") > high).alias("above"),
                           F.count_if(F.col("score") >= low).alias("upto")).collect()[0]
        if outside.above < wanted <= outside.upto:
            return low, high, outside.above
        width *= 8


def draw(spark: SparkSession, scores: DataFrame, percent: int = 10, least_features: int = 20,
         error: float = SKETCH_ERROR) -> DataFrame:
    """The columns of ``scores`` and ``rank``: 1, 2, 3 ... for the drawn documents, else null.

    Of the N documents with at least ``least_features`` features, the
    ``floor(percent * N / 100)`` highest in the draw's order are drawn.
    ``scores`` is a staged table.
    """
    able = scores.where(F.col("n_features") >= least_features)
    n = able.count()
    wanted = percent * n // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scores.select("*", none)
    low, high, above = bracket(able, n, wanted, error)
    inside = ranked(spark, able.where(F.col("score").between(low, high)))
    last = inside.where(F.col("rank") == wanted - above).collect()[0]
    # at or before the cutoff; rows alike in score and id may tie across it
    score, key = F.col("score"), F.col("id")
    tie = F.lit(True) if last["id"] is None else key <= last["id"]
    at = (F.col("n_features") >= least_features) & ((score > last["score"]) | (
        (score == last["score"]) & F.coalesce(tie, F.lit(False))))
    places = ranked(spark, scores.where(at)).withColumn(
        "rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return reduce(DataFrame.unionByName, [scores.where(~at).select("*", none), places])
