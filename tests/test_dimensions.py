from strata.operators.dedupe import distinct_by_key
from strata.operators.dimensions import (
    append_new_keys,
    genre_junction,
    genre_lookup,
    languages,
)
from strata.operators.repair import repair_abs, repair_by_lookup
from pyspark.sql import functions as F

SCHEMA = "Id BIGINT, OriginalLanguage STRING, genres ARRAY<STRUCT<id: INT, name: STRING>>"


def _records(spark):
    rows = [
        (1, "en", [(1, "Drama"), (2, "Comedy")]),
        (2, "en", [(1, "Drama"), (1, "Drama")]),
        (3, "fr", None),
        (4, "de", []),
        (5, "en", [(3, "")]),
        (6, "en", [(2, "Komödie")]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_genre_lookup_deterministic(spark):
    got = sorted(tuple(r) for r in genre_lookup(_records(spark)).collect())
    assert got == [(1, "Drama"), (2, "Komödie"), (3, "")]


def test_genre_junction(spark):
    got = sorted(tuple(r) for r in genre_junction(_records(spark)).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (5, 3), (6, 2)]


def test_append_new_keys(spark):
    existing = spark.createDataFrame([(1, "Drama")], "genre_id INT, genre_name STRING")
    new = genre_lookup(_records(spark))
    got = sorted(r.genre_id for r in append_new_keys(new, existing, "genre_id").collect())
    assert got == [2, 3]


def test_append_new_keys_null_once(spark):
    ddl = "genre_id INT, genre_name STRING"
    new = spark.createDataFrame([(None, "x"), (1, "Drama")], ddl)
    assert append_new_keys(new, spark.createDataFrame([(None, "x")], ddl), "genre_id").collect()[0].genre_id == 1
    assert append_new_keys(new, new, "genre_id").count() == 0


def test_languages_bag_and_set(spark):
    assert languages(_records(spark)).count() == 6
    assert languages(_records(spark), distinct=True).count() == 3


def test_repair_abs_keeps_null_and_zero(spark):
    df = spark.createDataFrame([(-5,), (0,), (None,), (7,)], "RunTime BIGINT")
    assert [r.RunTime for r in repair_abs(df).collect()] == [5, 0, None, 7]


def test_repair_by_lookup_inner_semantics(spark):
    q = spark.createDataFrame([(1, 10), (2, 20), (3, 99)], "event_id INT, device_id BIGINT")
    u = spark.createDataFrame([(10, "7"), (20, "8"), (20, "9")], "user_id BIGINT, device_id STRING")
    out = repair_by_lookup(q, u, "device_id", "user_id",
                           {"event_id": F.col("q.event_id"), "device_id": F.col("u.device_id").cast("int")})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 7), (2, 8), (2, 9)]


def test_distinct_by_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k INT, v STRING")
    assert sorted(tuple(r) for r in distinct_by_key(df, "k", ["v"]).collect()) == [(1, "b"), (2, "c")]
