import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from strata.llm.centroids import Search, centroid_hash, cluster
from strata.llm.common import staged

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(x, centroids):
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for v in x]
    return [r.index(min(r)) for r in d], [min(r) for r in d]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(1, 20), st.sampled_from([2, 50, 2**27 - 1]), st.randoms())
def test_search_is_exact(size, k, n, most, rng):
    """Few values make ties and equal means; large ones stretch the bounds."""
    some = lambda m: np.array([[rng.randint(-most, most) for _ in range(size)] for _ in range(m)], np.int64)
    x, centroids = some(n), some(k)
    x = np.concatenate([x, centroids, np.full((1, size), most), x + (0 if most > 50 else 1)])
    number, distance = Search(centroids).nearest(x)
    assert (number.tolist(), distance.tolist()) == brute(x, centroids)


def test_near_constant_vectors_of_large_mean():
    rng = np.random.default_rng(2)
    centroids = 2**26 + rng.integers(-3, 4, (40, 64))
    x = 2**26 + rng.integers(-3, 4, (300, 64))
    number, distance = Search(centroids).nearest(x)
    assert (number.tolist(), distance.tolist()) == brute(x, centroids)


def test_most_distances_are_rejected():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-50, 50, (64, 16)) + rng.integers(-2000, 2000, (64, 1))
    search = Search(centroids)
    x = centroids[rng.integers(0, 64, 2000)] + rng.integers(-5, 5, (2000, 16))
    number, distance = search.nearest(x)
    assert (number.tolist(), distance.tolist()) == brute(x, centroids)
    assert search.computed < 0.2 * len(x) * len(centroids)


def plain(rows, k=8, rounds=10, size=64):
    """The contract step by step, with Python's integers."""
    kept = [(i, [math.floor(1024 * float(np.float32(e))) for e in v]) for i, v in rows
            if v is not None and len(v) == size and all(e is not None and math.isfinite(e) for e in v)]
    key = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    x = [v for _, v in kept]
    for _ in range(rounds if x else 0):
        number, _ = brute(x, centroids)
        for c in range(len(centroids)):
            mine = [v for v, m in zip(x, number, strict=True) if m == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    number, distance = brute(x, centroids) if x else ([], [])
    total = [sum(d for d, m in zip(distance, number, strict=True) if m == c) for c in range(len(centroids))]
    return sorted((repr(i), m, d, total[m], sum(total), centroid_hash(np.array(centroids[m])))
                  for (i, _), m, d in zip(kept, number, distance, strict=True))


def table(spark, rows):
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "'x' AS id", "1 AS cluster", "2 AS vector")
    return staged(spark, df.repartition(3), "vectors")


def result(spark, rows):
    found, _ = cluster(spark, table(spark, rows))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((repr(r[0]), *r[1:]) for r in found.collect())


def test_clusters_as_by_hand(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(64)]) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(70)]  # copies on one spot: ties
    rows += [(7, rows[7][1]), (None, rows[9][1])]  # a repeated row, a null id
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65), (2004, [None] + [0.5] * 63),
             (2005, [float("nan")] * 64), (2006, [float("inf")] + [0.0] * 63), (2007, [-1e-20] * 64)]
    assert result(spark, rows) == plain(rows)


def test_few_and_no_vectors(spark):
    same = [(i, [0.25] * 64) for i in range(12)]  # equal centroids: all but the first stay empty
    assert result(spark, same) == plain(same) and {r[1] for r in result(spark, same)} == {0}
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert result(spark, few) == plain(few)
    assert result(spark, []) == [] and result(spark, [(1, None)]) == []


def test_too_large_components_are_named(spark):
    with pytest.raises(Exception, match="64 bits"):
        cluster(spark, table(spark, [(1, [3e38] * 64)]))
