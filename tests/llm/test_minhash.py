import random

import numpy as np
import pyarrow as pa

from strata.llm import minhash
from strata.llm.components import components
from strata.llm.minhash import drop_near_copies, near_classes


def words(rng, n):
    return [f"w{rng.randrange(100_000)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for i in rng.sample(range(len(out)), edits):
        out[i] = f"e{rng.randrange(10**9)}"
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute_classes(rows):
    """Components of the plain Jaccard graph, as sets of ids."""
    sets = {i: shingles(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                parent[root(b)] = root(a)
    out = {}
    for i in ids:
        out.setdefault(root(i), set()).add(i)
    return {frozenset(x) for x in out.values()}


def found_classes(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.class_id, set()).add(r.doc_id)
        assert r.kept == (r.class_id == r.doc_id)
    return {frozenset(x) for x in out.values()}


def corpus(rng):
    rows, i = [], 0
    passage = words(rng, 60)
    for size, edits in [(2, 1), (3, 2), (8, 3), (40, 2), (120, 4)]:
        base = words(rng, 180)
        for _ in range(size):
            rows.append((i, " ".join(edited(rng, base, edits)), "en", "s"))
            i += 1
    for _ in range(80):  # share a passage, not more
        rows.append((i, " ".join(words(rng, 50) + passage + words(rng, 50)), "en", "s"))
        i += 1
    chain = words(rng, 300)  # neighbours are near, the ends are not
    for _ in range(12):
        rows.append((i, " ".join(chain), "en", "s"))
        chain = edited(rng, chain, 5)
        i += 1
    for n in (1, 3, 4, 5, 6):
        t = words(rng, n)
        rows += [(i, " ".join(t), "en", "s"), (i + 1, "  ".join(t).upper() + "\n", "en", "s"),
                 (i + 2, " ".join(words(rng, n)), "en", "s")]
        i += 3
    rows += [(i, None, "en", "s"), (i + 1, "", "en", "s"), (i + 2, " \n", "en", None)]
    big = words(rng, 30_000)
    rows += [(i + 3, " ".join(big), "en", "s"), (i + 4, " ".join(edited(rng, big, 200)), "en", "s")]
    return rows


def test_classes_match_brute_force(spark, documents):
    rows = corpus(random.Random(11))
    docs = documents(rows, extra=("class", "bands"))
    assert found_classes(near_classes(spark, docs)) == brute_classes(rows)


def test_repeated_rows_and_null_ids(spark, documents):
    rng = random.Random(2)
    t = " ".join(words(rng, 100))
    docs = documents([(7, t, "en", "s")] * 30 + [(None, t, "en", "s"), (8, t + " end", "en", "s")])
    out = drop_near_copies(spark, docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [7]


def test_empty_table(spark, documents):
    docs = documents([])
    assert near_classes(spark, docs).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    both, own = 400, 150
    shared = rng.integers(1, 2**63, both, dtype=np.uint64)
    parts = [np.concatenate([shared, rng.integers(1, 2**63, own, dtype=np.uint64)]) for _ in range(2)]
    w = rng.uniform(0.5, 3, (2, both + own)).astype(np.float32)
    w[1, :both] = w[0, :both] * 1.3
    a, b = (minhash._samples(parts[i], w[i], np.zeros(both + own, dtype=np.int64), 1)[0] for i in (0, 1))
    want = w[0, :both].sum() / (w[1, :both].sum() + w[0, both:].sum() + w[1, both:].sum())
    trials = []
    for k in range(40):  # other hashes, other samples
        mixed = [p ^ np.uint64(k * 0x9E3779B97F4A7C15 % 2**64) for p in parts]
        a, b = (minhash._samples(mixed[i], w[i], np.zeros(both + own, dtype=np.int64), 1)[0] for i in (0, 1))
        trials.append((a == b).mean())
    assert abs(np.mean(trials) - want) < 0.04


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (200, 200)]
    got = components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 200: 200}


def test_plain_similarity_of_common_words_links(spark, documents):
    """Pairs of plain similarity 0.81 whose shared words a third of the rows hold; each has one partner only."""
    rng = random.Random(17)
    passages, rows = [words(rng, 30) for _ in range(40)], []
    for _ in range(30):
        held = sorted(rng.sample(range(40), 30))
        shared = [w for k in held for w in passages[k]]
        for _ in range(2):
            rows.append((len(rows), " ".join(shared + words(rng, 100)), "en", "s"))
    rows += [(len(rows) + i, " ".join(words(rng, 60)), "en", "s") for i in range(120)]
    want = brute_classes(rows)
    assert sum(len(x) == 2 for x in want) == 30
    assert found_classes(near_classes(spark, documents(rows))) == want


def test_limits_follow_the_threshold():
    assert minhash.least(0.8) == (2, 30)
    assert minhash.least(0.5)[0] == 1 and minhash.least(0.5)[1] < 24


def test_first_two_bands_are_those_of_the_keys():
    """Band 1 has equal fingerprints but other keys; the pair meets under bands 3 and 5 only."""
    samples = np.zeros((2, 48), np.uint8)
    samples[1, [k * 3 for k in range(16) if k not in (1, 3, 5)]] = 1
    keys = np.arange(32).reshape(2, 16)
    keys[1, [3, 5]] = keys[0, [3, 5]]
    block = pa.table({"node": [7, 8], "label": [7, 8], "now": [7, 8], "second": [False, False], "low": [3, 3], "high": [5, 5],
                      "samples": [x.tobytes() for x in samples], "keys": keys.tolist()})
    got = minhash._agreeing(30)((0, 0, 0), block)
    assert list(zip(got["a"].to_pylist(), got["b"].to_pylist())) == [(7, 8)]


def test_all_pairs_of_two_classes_are_tried(spark, documents, monkeypatch):
    """Two classes of 12; of their 144 pairs, which all agree enough, one that does not agree most is similar."""
    base = " ".join(words(random.Random(23), 200))
    rows = [(i, f"{base} {'ab'[i // 12]} {i % 12}", "en", "s") for i in range(24)]

    def check(weights, threshold):
        def similar(batches):
            for batch in batches:
                ends = zip(*[[t.split()[-2:] for t in batch.column(c).to_pylist()] for c in ("text_a", "text_b")],
                           strict=True)
                keep = pa.array([a[0] == b[0] or sorted([a, b]) == [["a", "9"], ["b", "2"]] for a, b in ends], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

        return similar

    monkeypatch.setattr(minhash, "_similar", check)
    assert found_classes(near_classes(spark, documents(rows))) == {frozenset(range(24))}


def test_a_block_names_each_pair_in_one_turn_and_few_at_a_time():
    """Nodes that agree in all bands: a round names no more pairs than its part of the lists, all rounds each pair once."""
    rng, n = np.random.default_rng(3), 60
    samples = np.zeros((n, 48), np.uint8)
    samples[np.arange(n), rng.integers(0, 48, n)] = rng.integers(1, 5, n)
    node = rng.permutation(1000)[:n]
    for second in (np.zeros(n, bool), np.arange(n) >= 25):
        block = pa.table({"node": node, "label": node, "now": node, "second": second, "low": [0] * n, "high": [1] * n,
                          "samples": [x.tobytes() for x in samples], "keys": [[1] * 16] * n})
        seen, start, stop = [], 0, 1
        while True:
            got = minhash._agreeing(30, start, stop)((0, 0, 0), block)
            pairs = [(a, b) for a, b in zip(got["a"].to_pylist(), got["b"].to_pylist()) if a is not None]
            assert len(pairs) <= (stop - start) * n
            seen += pairs
            if None not in got["a"].to_pylist():
                break
            start, stop = stop, stop * minhash.MORE
        want = {(min(a, b), max(a, b)) for i, a in enumerate(node.tolist()) for k, b in enumerate(node.tolist())
                if (i < k if not second.any() else second[k] and not second[i])}
        assert len(seen) == len(set(seen)) and set(seen) == want
        joined = minhash._agreeing(30)((0, 0, 0), block.set_column(2, "now", pa.array(np.zeros(n, np.int64))))
        assert joined.num_rows == 0


def test_small_buckets_are_compared_like_blocks():
    """Random buckets of 2 to 24 nodes: the same pairs in the same turns from both forms."""
    rng = np.random.default_rng(8)
    buckets = []
    for pair in range(60):
        n = int(rng.integers(2, 25))
        samples = np.zeros((n, 48), np.uint8)
        samples[rng.random((n, 48)) < rng.choice([0.1, 0.3])] = 1
        keys = rng.integers(10, 60, (n, 16))
        low, high = sorted(rng.choice(16, 2, replace=False).tolist())
        keys[:, [low, high]] = 1
        label = rng.integers(0, 4, n)
        now = np.where(label == 3, 2, label)
        buckets.append((pair, low, high, rng.permutation(10_000)[:n], label, now, keys, samples))
    rows = [{"pair": p, "low": low, "high": high, "held": [
        {"node": int(a), "label": int(b), "now": int(c), "keys": k.tolist(), "samples": s.tobytes()}
        for a, b, c, k, s in zip(node, label, now, keys, samples)]} for p, low, high, node, label, now, keys, samples in buckets]
    for start, stop in ((0, 1), (1, 4), (0, 100)):
        got = [r for b in minhash._agreeing_small(30, start, stop)(iter(pa.table(
            {c: [r[c] for r in rows] for c in rows[0]}).to_batches())) for r in b.to_pylist()]
        want = []
        for p, low, high, node, label, now, keys, samples in buckets:
            n = len(node)
            block = pa.table({"node": node, "label": label, "now": now, "second": [False] * n, "low": [low] * n, "high": [high] * n,
                              "samples": [x.tobytes() for x in samples], "keys": keys.tolist()})
            want += minhash._agreeing(30, start, stop)((p, 0, 0), block).to_pylist()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 5


def test_buckets_of_one_band_name_the_pairs_of_two(monkeypatch):
    """Random keys: whether dealt by one band or by two, in whole blocks, parts or strips, the same pairs come, each once."""
    rng, n = np.random.default_rng(12), 40
    keys, samples = rng.integers(0, 4, (n, 16)), np.zeros((n, 48), np.uint8)
    node, label = rng.permutation(1000)[:n], rng.integers(0, 30, n)
    want = {(min(node[i], node[j]), max(node[i], node[j])) for i in range(n) for j in range(i)
            if label[i] != label[j] and (keys[i] == keys[j]).sum() >= 2}

    def block(held, low, high, second):
        return pa.table({"node": node[held], "label": label[held], "now": label[held], "second": second, "low": [low] * len(held),
                         "high": [high] * len(held), "samples": [samples[i].tobytes() for i in held], "keys": keys[held].tolist()})

    def pairs(buckets, parts):
        out = []
        for low, high in buckets:
            for value in {(k[low], k[high]) for k in keys.tolist()}:
                held = np.flatnonzero((keys[:, [low, high]] == value).all(axis=1))
                for x in range(parts):
                    for y in range(x, parts):
                        here = held[(node[held] % parts == x) | (node[held] % parts == y)]
                        if len(here):
                            got = minhash._agreeing(30, 0, n, 2)(
                                (0, x, y), block(here, low, high, (node[here] % parts == y) & (x != y)))
                            out += zip(got["a"].to_pylist(), got["b"].to_pylist(), strict=True)
        assert len(out) == len(set(out))
        return set(out)

    one, two = [(x, x) for x in range(16)], [(x, y) for x in range(16) for y in range(x + 1, 16)]
    for size in (1024, 3):
        monkeypatch.setattr(minhash, "BLOCK", size)
        assert pairs(one, 1) == pairs(one, 3) == pairs(two, 1) == want
    rows = [{"pair": x * 4 + k, "low": x, "high": x, "held": [
        {"node": int(node[i]), "label": int(label[i]), "now": int(label[i]), "keys": keys[i].tolist(), "samples": samples[i].tobytes()}
        for i in np.flatnonzero(keys[:, x] == k)]} for x in range(16) for k in range(4)]
    small = [r for b in minhash._agreeing_small(30, 0, n, 2)(iter(pa.Table.from_pylist(rows).to_batches())) for r in b.to_pylist()]
    assert {(r["a"], r["b"]) for r in small} == want and len(small) == len(want)


def test_pairs_become_lists_and_cells():
    """Random pairs, some twice: lists and then cells hold each once, with both of its nodes."""
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 30, (2, 300))
    a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    named = minhash._named_rows(a, b, a, a.astype(np.int32), a.astype(np.int32), [(7, 1, 2)])
    got = minhash._listed(named).to_pylist()
    assert [(r["pair"], r["x"], r["y"]) for r in got if r["node"] is None] == [(7, 1, 2)]
    got = [r for r in got if r["node"] is not None]
    assert len(got) == len({*a, *b}) and all(len(r["partners"]) + len(r["met"]) == (a == r["node"]).sum() + (b == r["node"]).sum()
                                             for r in got)
    part = lambda x: x * 7 % 5
    rows = pa.table({"node": [r["node"] for r in got], "part": [part(r["node"]) for r in got], **{
        k: pa.array([[f(x) for x in r[c]] for r in got], pa.list_(pa.int64()))
        for c in ("partners", "met") for k, f in ((c, int), (f"{c}_part", part))}})
    cells = [r for x in minhash._dealt_cells(5)(iter(rows.to_batches())) for r in x.to_pylist()]
    pairs = [(r["node"], x) for r in cells for x in r["partners"]]
    assert sorted(pairs) == sorted(set(zip(a.tolist(), b.tolist(), strict=True)))
    held = {(r["cell"], r["node"]) for r in cells}
    assert len(held) == len(cells) and held == {
        (min(part(x), part(y)) * 5 + max(part(x), part(y)), z) for x, y in pairs for z in (x, y)}


def test_a_large_group_costs_rows_by_its_texts_not_its_pairs(spark, documents, monkeypatch):
    """150 texts, all alike at 0.72 and apart but for two: rows of each round of the blocks are fewer than the texts' bands."""
    rng = random.Random(31)
    shared, rows = words(rng, 204), []
    for i in range(150):
        rows.append((i, " ".join(shared + words(rng, 35)), "en", "s"))
    rows.append((150, rows[3][1] + " end", "en", "s"))
    sizes, stage = [], minhash.stage_observed

    def observed(spark, df, label, *args):
        out = stage(spark, df, label, *args)
        sizes.append((label, out[0].count()))
        return out

    monkeypatch.setattr(minhash, "stage_observed", observed)
    want = brute_classes(rows)
    assert len(want) == 150 and found_classes(near_classes(spark, documents(rows))) == want
    named = [n for label, n in sizes if label == "named"]
    assert len(named) > 1 and max(named) <= 151 * minhash.KINDS * minhash.BANDS


def test_a_text_goes_to_cells_not_to_pairs(spark):
    """60 nodes, all 1,770 pairs: each pair is checked once, a text goes to 4 cells at most."""
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "node long, text string")
    pairs = spark.createDataFrame([(i, j) for i in range(60) for j in range(i + 1, 60)], "a long, b long")

    def check(batches):
        for batch in batches:
            for c in ("a", "b"):
                assert batch.column(f"text_{c}").to_pylist() == [f"text {x}" for x in batch.column(c).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(batch.column("text_a").dictionary)]),
                                              pa.array([batch.num_rows])], names=["a", "b"])

    seen = minhash._verified(spark, pairs, texts, check, 4)[0].collect()
    assert sum(r.b for r in seen) == 1770 and 60 <= sum(r.a for r in seen) <= 4 * 60


def test_pairs_are_verified_exactly():
    """Random texts with repeated shingles: weighted and plain similarity as by dictionaries of counts."""
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(4)]
    texts = [" ".join(edited(rng, rng.choice(base), rng.randrange(4)) * rng.choice([1, 1, 2])) for _ in range(30)] + ["one word"] * 2
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    weights = np.random.default_rng(5).uniform(0.5, 5, minhash.FREQ_CELLS).astype(np.float32)
    held = []
    for t in texts:
        shingle, _, count = minhash._shingles(minhash._normal(pa.array([t])))
        held.append(dict(zip(shingle.tolist(), (count * weights[minhash._cell(shingle)].astype(float)).tolist(), strict=True)))

    def similar(x, y):
        low = sum(min(x.get(k, 0), y.get(k, 0)) for k in x.keys() | y.keys())
        high = sum(max(x.get(k, 0), y.get(k, 0)) for k in x.keys() | y.keys())
        return max(low / high, len(x.keys() & y.keys()) / len(x.keys() | y.keys())) >= 0.8

    side = lambda k: pa.DictionaryArray.from_arrays(pa.array([p[k] for p in pairs], pa.int32()), pa.array(texts))
    batch = pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs]), side(0), side(1)],
                                       names=["a", "b", "text_a", "text_b"])
    want = {p for p in pairs if similar(held[p[0]], held[p[1]])}
    for partners in (minhash.PARTNERS, 100):
        old, minhash.PARTNERS = minhash.PARTNERS, partners
        try:
            got = [tuple(r.values()) for b in minhash._similar(weights, 0.8)(iter([batch])) for r in b.to_pylist()]
        finally:
            minhash.PARTNERS = old
        assert len(got) == len(want) and set(got) == want and 3 < len(want) < len(pairs)


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(6)
    many = ["ab", "ba", "a", "aa", "é", "x" * 2000, "y" + "x" * 1999, *words(rng, 3000)]
    mixed = rng.sample(many * 2, 2 * len(many))
    hashes = minhash._word_hashes(pa.array(mixed))
    of = {}
    for word, value in zip(mixed, hashes.tolist(), strict=True):
        assert of.setdefault(word, value) == value
    assert len(set(of.values())) == len(set(many))
    assert len(minhash._word_hashes(pa.array([], pa.string()))) == 0
