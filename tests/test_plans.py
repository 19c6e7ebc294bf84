"""Plan-shape checks: pushdown, no Python evaluation, broadcast only when checked."""

import __spark_entry__ as E
from strata.functions.records import parse_records, unpack
from strata.operators.merge import merge_update
from strata.operators.quality import classify
from strata.plans.raw_to_bronze import raw_to_bronze
from strata.session import fresh_dir
from strata.sinks.envelope import write_envelope
from strata.sources.driver_tables import movie_records
from strata.sources.tables import read_by_status

from conftest import SF0001

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "PythonUDF", "pythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _bronze(spark):
    raw = fresh_dir(spark, "p-raw")
    write_envelope(movie_records(spark, SF0001), raw)
    b = fresh_dir(spark, "p-bronze")
    raw_to_bronze(spark, raw, b, ingest_ts="2024-01-31 12:00:00")
    return b


def test_status_filter_pushed_to_scan(spark):
    b = _bronze(spark)
    plan = _plan(read_by_status(spark, b, "new"))
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,new)]" in plan


def test_parse_prunes_and_stays_jvm(spark):
    b = _bronze(spark)
    df = classify(unpack(parse_records(read_by_status(spark, b, "new")))).select("Id", "outcome")
    plan = _plan(df)
    assert not any(n in plan for n in PY_NODES)
    assert "ReadSchema: struct<movie:string,status:string>" in plan


def test_merge_joins_on_digest_and_text(spark):
    b = spark.read.parquet(_bronze(spark))
    src = b.select("movie").withColumn("outcome", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("loaded"))
    plan = _plan(merge_update(b, src, "movie", {"status": "outcome"}))
    assert "xxhash64(movie" in plan


def test_no_python_in_registered_queries(spark):
    qs = E.queries()
    for name in ("split_clean", "genre_lookup", "json_permissive", "repair_lookup", "dedupe_rows"):
        plan = _plan(qs[name](spark, SF0001))
        assert not any(n in plan for n in PY_NODES), name


def test_merge_rewrite_reads_touched_partitions_only(spark):
    import datetime as dt

    import strata.operators.merge as mg

    path = fresh_dir(spark, "p-merge")
    rows = [(f"k{i}", "new", dt.date(2024, 1, 1 + i % 20)) for i in range(400)]
    spark.createDataFrame(rows, "movie STRING, status STRING, p_ingestdate DATE") \
        .write.partitionBy("p_ingestdate").parquet(path)
    src = spark.createDataFrame([("k3", "loaded")], "movie STRING, outcome STRING")
    plans = {}
    orig = mg._write_back

    def spy(spark_, rows, *a):
        plans["rewrite"] = _plan(rows)
        return orig(spark_, rows, *a)

    mg._write_back = spy
    try:
        mg.merge_update_path(spark, path, src, "movie", {"status": "outcome"})
    finally:
        mg._write_back = orig
    assert "(p_ingestdate#" in plans["rewrite"] and "= 2024-01-04)" in plans["rewrite"]
    assert "BroadcastHashJoin" in plans["rewrite"]
    got = {r.movie: r.status for r in spark.read.parquet(path).collect()}
    assert len(got) == 400 and got["k3"] == "loaded" and got["k4"] == "new"


def test_rewritten_bronze_files_are_clustered_by_status(spark):
    """Merge rewrites sort rows by status inside each file, so Parquet row groups
    carry narrow status ranges and status scans can skip row groups."""
    import glob

    import pyarrow.parquet as pq

    from strata.plans.bronze_to_silver import bronze_to_silver

    b = _bronze(spark)
    bronze_to_silver(spark, b, fresh_dir(spark, "p-silver"))
    files = glob.glob(f"{b}/p_ingestdate=*/*.parquet")
    assert files
    seen = set()
    for f in files:
        status = pq.read_table(f, columns=["status"]).column("status").to_pylist()
        assert status == sorted(status), f
        seen.update(status)
    assert seen == {"loaded", "quarantined", "new"}


def test_raw_to_bronze_and_silver_append_have_no_shuffle(spark):
    from pyspark.sql import functions as F

    from strata.plans.bronze_to_silver import classified_batch
    from strata.plans.raw_to_bronze import bronze_batch
    from strata.schemas import SILVER_COLUMNS

    raw = fresh_dir(spark, "p-raw2")
    write_envelope(movie_records(spark, SF0001), raw)
    c1 = bronze_batch(spark, raw, ingest_ts="2024-01-31 12:00:00", multiline=False)
    assert "Exchange" not in _plan(c1)
    b = _bronze(spark)
    clean = classified_batch(read_by_status(spark, b, "new")).where(F.col("outcome") == "loaded")
    assert "Exchange" not in _plan(clean.select(*SILVER_COLUMNS))


def test_dedupe_and_genre_lookup_aggregate_map_side(spark):
    from strata.operators.dimensions import genre_lookup
    from strata.functions.records import transform_bronze

    b = spark.read.parquet(_bronze(spark))
    for df in (transform_bronze(b), genre_lookup(transform_bronze(b))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        # final aggregate above the shuffle, partial aggregate below it: hot keys
        # collapse in each map task before the exchange
        first_agg = plan.index("HashAggregate")
        exchange = plan.index("Exchange hashpartitioning", first_agg)
        assert plan.find("HashAggregate", exchange) > exchange
