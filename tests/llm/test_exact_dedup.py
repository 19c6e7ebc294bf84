import hashlib

from pyspark.sql import functions as F

from strata.llm.exact_dedup import DigestIndex, drop_exact_copies, exact_dedup


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        key = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, i))
    out = {}
    for key, group in groups.items():
        for x in group:
            out.setdefault(x[3], set()).add((min(group)[3], len(group), hashlib.sha256(key.encode()).hexdigest()))
    return out


ROWS = [(5, "a b", "en", "s"), (3, "ab", "en", "s"), (4, "a\tb", "en", "s"), (9, None, "en", None),
        (8, "", None, "s"), (7, " \r\n", "en", "s"), (10, "x y", "en", "s"), (11, "xy", "en", "s"),
        (12, "z" * 300_000, "en", "s"), (13, "z" * 300_000 + " ", "en", "s"), (None, "q", "en", "s")]


def test_matches_brute_force(spark, documents):
    docs = documents(ROWS, extra=("digest", "kept"))
    got = exact_dedup(spark, docs).withColumn("h", F.lower(F.hex("digest"))).collect()
    want = brute(ROWS)
    assert len(got) == len(ROWS)
    for r in got:
        assert {(r.keep_id, r.group_size, r.h)} == want[r.doc_id]
        assert r.kept == (r.keep_id == r.doc_id)


def test_repeated_rows_keep_one(spark, documents):
    docs = documents([(1, "same", "en", "s")] * 40 + [(2, "other", "en", "s"), (None, "same", "en", "s")])
    out = drop_exact_copies(spark, docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]


def test_index_persists_over_batches(spark, documents):
    index = DigestIndex(spark, buckets=4)
    first = exact_dedup(spark, documents([(1, "a", "en", "s"), (2, "a ", "en", "s"), (3, "b", "en", "s")]), index)
    assert {r.doc_id for r in first.where("kept").collect()} == {2, 3}
    again = DigestIndex(spark, path=index.path, buckets=4)  # opened anew, as another session does
    second = exact_dedup(spark, documents([(7, "a", "en", "s"), (8, "c", "en", "s")]), again)
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(7, 2, False), (8, 8, True)}
    assert again.read().count() == 3


def test_empty_table(spark, documents):
    docs = documents([])
    assert exact_dedup(spark, docs).count() == 0
    assert drop_exact_copies(spark, docs).count() == 0
