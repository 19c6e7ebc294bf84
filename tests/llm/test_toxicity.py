import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.toxicity import fit, grams, learn, score, scores

INSULTS = ["blockhead", "nincompoop", "scoundrel"]


def text(rng, bad, n=150):
    words = ["".join(rng.choices(["the", "on", "er", "and", "st", "ing", "ou"], k=rng.randrange(1, 4))) for _ in range(n)]
    for i in rng.sample(range(n), 3) if bad else ():
        words[i] = rng.choice(INSULTS)
    return " ".join(words)


def sample(n=240):
    rng = random.Random(6)
    labels = np.array([i % 4 == 0 for i in range(n)]).astype(int)
    return [text(rng, y) for y in labels], labels


def test_held_out_and_misspelt():
    texts, labels = sample()
    model = fit(texts[:160], labels[:160])
    p = scores(model, pa.array(texts[160:]))
    assert ((p >= 0.7) == labels[160:]).mean() > 0.95
    rng = random.Random(9)
    clean = text(rng, False, 60)
    odd = [clean + " nincompooop you blockheads " + text(rng, False, 9), clean + " scoundrell blokhead",
           clean.upper() + " SCOUNDRELS!!! nincompoops", clean]
    assert [x >= 0.7 for x in scores(model, pa.array(odd))] == [True, True, True, False]


def test_same_result_on_every_run():
    texts, labels = sample(80)
    a, b = fit(texts, labels), fit(texts, labels)
    assert a.offset == b.offset and (a.cells == b.cells).all()


def test_highest_window_matches_brute_force():
    texts, labels = sample(80)
    model = fit(texts, labels)
    got = scores(model, pa.array(texts))
    for t, p in list(zip(texts, got))[:20]:
        logits = []
        words = t.split()
        for i in range(0, len(words), toxicity.WINDOW):
            total = 0.0
            for w in words[i:i + toxicity.WINDOW]:
                cell, _ = grams(pa.array([w]))
                total += float(np.mean(model.cells[cell].astype(float)))
            logits.append(total / toxicity.WINDOW + model.offset)
        assert abs(p - 1 / (1 + np.exp(-max(logits)))) < 1e-6


def test_defined_cases(spark, documents):
    rng = random.Random(2)
    rows = [(i, text(rng, i % 3 == 0), "en", "s") for i in range(120)]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, " ### ", "en", "s"), (203, text(rng, False, 30_000), "en", "s")]
    docs = documents(rows, extra=("place", "toxic"))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(0, 0), (5, None), (999, 1)],
                                   "doc_id long, toxic int")
    model = learn(docs, labels)
    got = {r.doc_id: r.score for r in score(docs, model, F.col("doc_id")).collect()}
    assert len(got) == len(rows) and all(0 <= p <= 1 for p in got.values())
    assert got[200] == got[201] == got[202] < 0.7 and got[203] < 0.7
    none = learn(docs, labels.where("toxic = 0"))
    assert {r.score for r in score(docs, none, F.col("doc_id")).collect()} == {0.0}
    assert score(documents([]), model, F.col("doc_id")).count() == 0
