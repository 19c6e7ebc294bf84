from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.quality import (
    OUTCOME,
    assert_schema,
    classify,
    drop_incomplete,
    null_profile,
    split,
)
from strata.schemas import BRONZE_SCHEMA, RECORD_DDL
from strata.functions.metadata import ingest_metadata

# FIXTURES.md section B: (RunTime, Budget) -> class
TRUTH = [
    (148, 160000000.0, "loaded"),
    (1, 1000000.0, "loaded"),
    (-5, 10.0, "quarantined"),
    (0, None, "quarantined"),
    (None, 2000000.0, "new"),
    (90, None, "new"),
    (None, None, "new"),
    (None, 5000000.0, "new"),
    (None, 10.0, "quarantined"),
]


def test_truth_table(spark):
    df = spark.createDataFrame([(i, r, b) for i, (r, b, _) in enumerate(TRUTH)],
                               "i INT, RunTime BIGINT, Budget DOUBLE")
    got = {r.i: r[OUTCOME] for r in classify(df).collect()}
    assert got == {i: c for i, (_, _, c) in enumerate(TRUTH)}


def test_nulls_quarantine_option(spark):
    df = spark.createDataFrame([(None, None), (5, 2e6)], "RunTime BIGINT, Budget DOUBLE")
    got = sorted(r[OUTCOME] for r in classify(df, nulls="quarantine").collect())
    assert got == ["loaded", "quarantined"]
    clean, bad, rest = split(df, nulls="quarantine")
    assert (clean.count(), bad.count(), rest.count()) == (1, 1, 0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)),
                          st.one_of(st.none(), st.sampled_from([0.0, 999999.0, 1e6, 2e6]))),
                min_size=0, max_size=40))
def test_split_is_a_partition(spark, rows):
    df = spark.createDataFrame(rows, "RunTime BIGINT, Budget DOUBLE")
    parts = split(df)
    back = sorted((tuple(r) for p in parts for r in p.collect()), key=repr)
    assert back == sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "d")], "x INT, y STRING")
    r = null_profile(df).collect()[0]
    assert (r.n_rows, r.n_complete) == (4, 2)
    assert drop_incomplete(df).count() == 2


def test_bronze_schema_assertion(spark):
    raw = spark.createDataFrame([("{}",)], "movie STRING")
    b = ingest_metadata(raw, ingest_ts="2024-01-31 12:00:00")
    assert_schema(b, BRONZE_SCHEMA)
    try:
        assert_schema(b.withColumn("status", F.lit(None).cast("string")), BRONZE_SCHEMA)
    except AssertionError as exc:
        assert "nullable" in str(exc)
    else:
        raise AssertionError("expected a nullability mismatch")


def test_record_schema_from_ddl(spark):
    from pyspark.sql.types import StructType
    st_ = StructType.fromDDL(RECORD_DDL)
    assert len(st_.fields) == 19
    assert st_["genres"].dataType.simpleString() == "array<struct<id:int,name:string>>"


def test_split_materialized_reads_staged_files(spark):
    df = spark.createDataFrame([(i % 7 - 2, float(i * 300000)) for i in range(50)],
                               "RunTime BIGINT, Budget DOUBLE")
    lazy = [sorted(tuple(r) for r in p.collect()) for p in split(df)]
    parts = split(df, materialize=True)
    assert [sorted(tuple(r) for r in p.collect()) for p in parts] == lazy
    assert all("FileScan parquet" in p._jdf.queryExecution().executedPlan().toString() for p in parts)
