import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.importance import bracket, draw, feature_buckets, ranked, scored

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, size=1):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORDS.findall(lower)
    return [" ".join(w[i:i + n]) for n in range(1, size + 1) for i in range(len(w) - n + 1)]


def buckets_of(text, buckets, size=1):
    return sorted(zlib.crc32(f.encode()) % buckets for f in features(text, size))


TEXTS = ["", None, "The cat, THE hat", "Ärger ÄÖ ñandú İI 漢字 x9y_z", "...", "a", "\x00a\x7fb{c}d`e", "tail ", " 1 2 3"]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_features(size):
    rng = random.Random(size)
    texts = TEXTS + [" ".join(rng.choices(["aa", "b", "C", "É", "-", "9"], k=rng.randrange(9))) for _ in range(200)]
    whole = pa.array(["skipped", *texts]).slice(1)
    found, owner = feature_buckets(whole, 997, size)
    assert (owner[1:] >= owner[:-1]).all()
    for i, t in enumerate(texts):
        assert sorted(found[owner == i].tolist()) == buckets_of(t, 997, size)


def plain(docs, target, percent=10, least=20):
    """The contract step by step."""
    def count(texts):
        n = [0] * 10_000
        for t in texts:
            for b in buckets_of(t, 10_000):
                n[b] += 1
        return n

    s, t = count(x for _, x in docs), count(target)
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (s_all + 10_000) / ((a + 1) * (t_all + 10_000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        b = buckets_of(text, 10_000)
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(able):
        r.append(place + 1 if place < percent * len(able) // 100 else None)
    return sorted(repr([*r, None][:5]) for r in rows)


def result(spark, docs, target, **how):
    scores = scored(spark, docs, target)
    found = draw(spark, scores, **how)
    assert found.columns == ["id", "n_features", "weight", "score", "rank"]
    return sorted(repr(list(r)) for r in found.collect())


def test_draw_as_by_hand(spark, documents):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(400)]
    rows += [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1] + " a" * 30)]
    docs = documents([(i, t, "en", "s") for i, t in rows], extra=("packed", "id", "rank"))
    target = [" ".join(rng.choices(words[:40], k=80)) for _ in range(9)] + [None]
    wanted = documents([(i, t, None, None) for i, t in enumerate(target)])
    assert result(spark, docs, wanted) == plain(rows, target)
    assert result(spark, docs, wanted, percent=100) == plain(rows, target, 100)
    assert result(spark, docs, documents([])) == plain(rows, [])


def test_empty_and_small_tables(spark, documents):
    none = documents([])
    assert result(spark, none, none) == []
    few = [(1, "a b c"), (2, "x " * 30)]
    docs = documents([(i, t, "en", "s") for i, t in few])
    assert result(spark, docs, docs) == plain(few, [t for _, t in few])


def test_equal_scores_go_to_smaller_ids(spark):
    """Half of all rows share one score, which holds the cutoff."""
    rows = [(i, 25, 0, 5 if i % 2 else i % 7 - 20) for i in range(1, 2001)]
    scores = staged(spark, spark.createDataFrame(rows, "id long, n_features long, weight long, score long"), "scores")
    got = {r.id: r["rank"] for r in draw(spark, scores).collect()}
    drawn = sorted((i for i in got if got[i]), key=lambda i: got[i])
    assert drawn == [i for i in range(1, 400, 2)] and [got[i] for i in drawn] == list(range(1, 201))


@pytest.mark.parametrize("error", [1e-4, 0.3])
def test_bracket_is_exact_whatever_the_sketch(spark, error):
    rng = random.Random(9)
    values = [int(rng.gauss(0, 1000)) for _ in range(5000)]
    able = staged(spark, spark.createDataFrame([(v,) for v in values], "score long"), "scores")
    for wanted in (1, 500, 4999, 5000):
        low, high, above = bracket(able, len(values), wanted, error)
        assert low <= sorted(values, reverse=True)[wanted - 1] <= high
        assert above == sum(v > high for v in values)


def test_ranks_over_many_ranges(spark):
    rows = spark.range(3000).select("id", F.lit(1).alias("n_features"), F.lit(0).alias("weight"),
                                    (F.col("id") * 7919 % 1009).alias("score"))
    got = ranked(spark, rows).collect()
    want = sorted(((-r.score, r.id) for r in got))
    assert [(-r.score, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 3001))
