"""K-means clustering in exact integers, by equal-average equal-variance search.

A vector's components become integers, ``floor(1024 * x)``. Each round assigns
every vector to its nearest centroid and moves each centroid to the floored
mean of its vectors; all sums and distances are integers, so a rerun, another
partitioning or a lost executor changes nothing.

Method: with n components, S the sum and W = sqrt(n * sum of squares - S^2) of a
vector or a centroid (mean and deviation, scaled by n),

    n * distance^2 >= (S - S')^2 + (W - W')^2

The centroids are sorted by S. A vector starts at the place of its own S and
goes outward, the nearer of its two sides first. Once the mean's term alone is
above the best distance, all centroids further out are rejected; a centroid
whose two terms are above it is rejected by itself. Only the others' distances
are computed, as exact integers. The bounds are floats, lowered by a slack far
above their rounding, so they reject nothing that could be nearest or tie.

Spread: vectors are staged once, packed. A round is one pass that shuffles a
row of sums for each task and cluster; the centroids (``k`` vectors) come to the
driver and travel with the next round.

Defined cases: a vector of another length, with a null or non-finite
component, or null itself is left out; repeated rows count each; a null id is
hashed as the empty text; fewer vectors than ``k`` give as many centroids; equal
centroids leave the later one empty, and an empty one stays where it is;
without vectors the result is empty. A component of 2^27 or more in size
(distances would pass 64 bits) ends the query with an error that says so.
Further columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import staged

SCALE = 1024
#: Sizes of components below this keep all distances of up to 64 components in 64 bits.
LARGEST = 1 << 27
#: Slack of the bounds: a share, and for deviations (whose means are rounded) a size too.
SLACK, SLACK_SIZE = 1e-9, 1e-5
#: Vectors that a task works on at once.
BLOCK = 8192


def _spread(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of each row, and its scaled deviation W (see the module)."""
    n = x.shape[1]
    total = x.sum(axis=1)
    apart = x - (total / n)[:, None]
    return total.astype(np.float64), np.sqrt(n * np.einsum("ij,ij->i", apart, apart))


class Search:
    """Nearest of a few centroids; equal distances go to the smaller number."""

    def __init__(self, centroids: np.ndarray) -> None:
        total, spread = _spread(centroids)
        self.order = np.argsort(total, kind="stable")
        self.centroids = centroids[self.order]
        self.total, self.spread = total[self.order], spread[self.order]
        self.computed = 0  # distances that were not rejected

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centroid, and the squared distance."""
        n, k = x.shape[1], len(self.order)
        total, spread = _spread(x)
        number = np.full(len(x), k, np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max, np.int64)
        above = np.searchsorted(self.total, total)
        below = above - 1
        rows = np.arange(len(x))
        while len(rows):
            down = np.where(below[rows] >= 0, total[rows] - self.total[np.maximum(below[rows], 0)], np.inf)
            up = np.where(above[rows] < k, self.total[np.minimum(above[rows], k - 1)] - total[rows], np.inf)
            mean = np.minimum(down, up) ** 2
            # by the mean: this centroid and all beyond it are too far
            near = mean <= n * best[rows].astype(np.float64) * (1 + SLACK)
            rows, down, up, mean = rows[near], down[near], up[near], mean[near]
            live = np.isfinite(mean)  # both sides may be used up
            rows, down, up, mean = rows[live], down[live], up[live], mean[live]
            at = np.where(down <= up, below[rows], above[rows])
            below[rows] -= down <= up
            above[rows] += down > up
            # by mean and deviation: this centroid is too far
            slack = SLACK_SIZE + SLACK * (spread[rows] + self.spread[at])
            apart = np.maximum(np.abs(spread[rows] - self.spread[at]) - slack, 0.0)
            close = mean + apart ** 2 <= n * best[rows].astype(np.float64) * (1 + SLACK)
            r, c = rows[close], at[close]
            self.computed += len(r)
            gap = x[r] - self.centroids[c]
            distance = np.einsum("ij,ij->i", gap, gap)
            own = self.order[c]
            better = (distance < best[r]) | ((distance == best[r]) & (own < number[r]))
            best[r[better]], number[r[better]] = distance[better], own[better]
        return number, best


def _blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows with their unpacked vectors."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            packed = b"".join(part.column("vector").to_pylist())
            yield part, np.frombuffer(packed, "<i4").reshape(-1, n).astype(np.int64)


def _packer(n: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.floor(SCALE * batch.column("components").flatten().to_numpy().reshape(-1, n))
            if (np.abs(values) >= LARGEST).any():
                raise ValueError(f"a component of {LARGEST} or more in size: distances would pass 64 bits")
            data = np.ascontiguousarray(values.astype("<i4")).tobytes()
            width = 4 * n
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([data[i:i + width] for i in range(0, len(data), width)], pa.binary())],
                names=["id", "vector"])

    return pack


def whole_vectors(spark: SparkSession, rows: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """Staged ``(id, vector)``: the packed integers of every whole vector."""
    v = F.col("components")
    raw = rows.select(F.col(f"`{key}`").cast("long").alias("id"),
                      F.col(f"`{vector}`").cast("array<double>").alias("components"))
    limit = F.lit(float("inf"))
    fine = (F.size(v) == size) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (x != limit) & (x != -limit))
    whole = raw.where(v.isNotNull() & F.coalesce(fine, F.lit(False)))
    return staged(spark, whole.mapInArrow(_packer(size), "id long, vector binary"), "vectors")


def first_centroids(vectors: DataFrame, k: int, seed: str, size: int) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in the order of the hashes."""
    text = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(text, 256).alias("hash"), "vector").orderBy("hash", "vector").limit(k).collect()
    return np.array([np.frombuffer(bytes(r.vector), "<i4") for r in first], np.int64).reshape(-1, size)


def _summer(centroids: np.ndarray) -> Callable:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, (k, n) = Search(centroids), centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, n), np.int64)
        for _, x in _blocks(batches, n):
            number, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            found, start = np.unique(number[order], return_index=True)
            total[found] += np.add.reduceat(x[order], start, axis=0)
            count += np.bincount(number, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]),
             pa.array(list(total[some]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    return add


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floored means, empty ones unchanged."""
    sums = vectors.select("vector").mapInArrow(_summer(centroids), "cluster int, n long, total array<long>")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    per = sums.select("cluster", "n", F.posexplode("total").alias("at", "part")).groupBy("cluster", "at").agg(
        wide("n"), wide("part")).collect()  # k * n rows at most
    out = centroids.copy()
    for r in per:
        out[r["cluster"], r["at"]] = int(r["part"]) // int(r["n"])
    return out


def _assigner(centroids: np.ndarray) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for part, x in _blocks(batches, centroids.shape[1]):
            number, distance = search.nearest(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(number, pa.int32()), pa.array(distance)],
                names=["id", "cluster", "distance"])

    return assign


def centroid_hash(centroid: np.ndarray) -> str:
    """Lower-case hex SHA-256 of the components, as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(spark: SparkSession, rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8,
            rounds: int = 10, size: int = 64, seed: str = "3:") -> tuple[DataFrame, np.ndarray]:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` and the final centroids."""
    if not 1 <= size <= 64:
        raise ValueError("vectors of 1 to 64 components are clustered")
    vectors = whole_vectors(spark, rows, key, vector, size)
    centroids = first_centroids(vectors, k, seed, size)
    for _ in range(rounds if len(centroids) else 0):
        new = moved(vectors, centroids)
        if (new == centroids).all():
            break  # a fixed point: further rounds change nothing
        centroids = new
    if len(centroids):
        found = staged(spark, vectors.mapInArrow(_assigner(centroids), "id long, cluster int, distance long"),
                       "clusters")
    else:
        found = vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    per = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows at most
    table = spark.createDataFrame(
        [(c, d, sum(per.values()), centroid_hash(centroids[c])) for c, d in sorted(per.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), centroids
