import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm.common import word_count
from strata.llm.mixing import fit_budget, mix, take_mix


def brute_targets(sizes):
    """Shares by weight; what stands above three times a source is shared out again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        level = rest / share if share else 0
        over = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= over


def test_fit_budget_is_best_on_small_cases():
    rng = random.Random(1)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(1, 40), rng.randrange(1, 5))))
        counts = np.array([rng.randrange(1, 4) for _ in lengths])
        budget = rng.randrange(0, int((lengths * counts).sum()) + 5)
        take = fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and (take >= 0).all()
        best = max(s for t in itertools.product(*[range(c + 1) for c in counts])
                   if (s := int((lengths * np.array(t)).sum())) <= budget)
        assert int((lengths * take).sum()) == best


def test_fit_budget_large():
    rng = np.random.default_rng(3)
    lengths, counts = np.arange(1, 6000), rng.integers(1, 400, 5999)
    for budget in (0, 1, 12345, 1_000_003, int((lengths * counts).sum()) - 7):
        take = fit_budget(lengths, counts, budget)
        assert (take <= counts).all() and 0 <= budget - int((lengths * take).sum()) <= 10


def corpus(rng):
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 60))), "en", s)
            for i, s in enumerate(rng.choices(["b", "a", None, "Ω", "é", "rare", "hot"], [9, 3, 5, 3, 2, 1, 40], k=900))]
    rows += [(1000, None, "en", "a"), (1001, "", "en", "void"), (1002, "x " * 20_000, "en", "b"),
             (1003, "a b\tc", "en", "b")]
    rows += [(2000 + i, "same words here", "en", "hot") for i in range(2500)]  # one length over many ranges
    return rows


def test_targets_sizes_and_taken(spark, documents):
    rows = corpus(random.Random(7))
    docs = documents(rows, extra=("key", "range", "copies"))
    got = mix(spark, docs).collect()
    assert len(got) == len(rows)
    text, source = {r[0]: r[1] for r in rows}, {r[0]: r[3] for r in rows}
    size = {i: len([w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]) for i, t in text.items()}
    sizes = {}
    for i in size:
        sizes[source[i]] = sizes.get(source[i], 0) + size[i]
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
    for s, words in taken.items():
        assert abs(words - want[s]) <= 1, (s, words, want[s])
    again = {r.doc_id: r.copies for r in mix(spark, docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_take_mix_repeats_documents(spark, documents):
    docs = documents([(1, "a b", "en", "a"), (2, "c d e f g h i j k l", "en", "b"), (3, None, "en", "c")])
    out = take_mix(spark, docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 3}  # target of b: 6 words, its only document has 10


def test_empty_table(spark, documents):
    assert mix(spark, documents([])).count() == 0


def test_word_count(spark):
    df = spark.createDataFrame([(None, 0), ("", 0), (" \n", 0), ("a", 1), (" a\x0bb c ", 2)], "t string, n int")
    assert df.where(word_count(F.col("t")) != F.col("n")).count() == 0
