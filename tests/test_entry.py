"""The driver contract, and every registered query against its DuckDB oracle."""


import duckdb
import pytest

import __spark_entry__ as E
from strata import registry

from conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    return v  # exact: doubles, dates and strings must equal DuckDB's


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["layer", "status", "n"]
    assert df.count() > 0


def test_oracles_cover_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.queries()) == set(registry.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                       "FlatMapGroupsInPandas")), "Python in the query plan"
    cols = sorted(df.columns)
    got = _rows([[r[c] for c in cols] for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = _rows([[r[i] for i in idx] for r in rel.fetchall()])
    assert got == exp
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "date": "DATE", "boolean": "BOOLEAN"}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        assert types.get(f.dataType.simpleString()) == duck_types[f.name], f.name


@pytest.mark.parametrize("name", ["ingest_metadata", "prepare_activity", "land_next_batch"])
def test_query_independent_of_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF0001)
        cols = sorted(df.columns)
        got = _rows([[r[c] for c in cols] for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(E.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    assert got == _rows([[r[i] for i in idx] for r in rel.fetchall()])
