import duckdb
from pyspark.sql import functions as F

from strata.plans.bronze_to_silver import bronze_to_silver
from strata.plans.raw_to_bronze import raw_to_bronze
from strata.plans.silver_update import repair_quarantined
from strata.session import fresh_dir, unique_name
from strata.sinks.catalog import register_table, use_database
from strata.sinks.envelope import write_envelope
from strata.sources.driver_tables import movie_records
from strata.sources.raw import raw_inventory, read_raw
from strata.sources.tables import read_by_status
from strata.streaming.bronze_stream import progress_rows, run_raw_to_bronze

from conftest import SF0001


def _raw(spark, records=None):
    path = fresh_dir(spark, "t-raw")
    write_envelope(records if records is not None else movie_records(spark, SF0001), path)
    return path


def _expected_split():
    con = duckdb.connect()
    q = f"""
    SELECT CASE WHEN rt > 0 AND b >= 1000000 THEN 'loaded'
                WHEN rt <= 0 OR b < 1000000 THEN 'quarantined' ELSE 'new' END s, count(*)
    FROM (SELECT o_totalprice * 10 b,
                 CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                      ELSE CAST(trunc(c_acctbal) AS BIGINT) END rt
          FROM '{SF0001}/orders.parquet' JOIN '{SF0001}/customer.parquet' ON o_custkey = c_custkey)
    GROUP BY 1"""
    return dict(con.sql(q).fetchall())


def test_envelope_round_trip(spark):
    path = _raw(spark)
    files = raw_inventory(spark, path, "*.txt").collect()
    assert files and all(f.length > 0 for f in files)
    assert read_raw(spark, path).count() == movie_records(spark, SF0001).count()


def test_medallion_end_to_end(spark):
    exp = _expected_split()
    raw = _raw(spark)
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    bt, st = unique_name("bronze_movie"), unique_name("silver_movie")
    raw_to_bronze(spark, raw, bronze, table=bt, ingest_ts="2024-01-31 12:00:00")
    assert read_by_status(spark, bt, "new").count() == sum(exp.values())
    bronze_to_silver(spark, bronze, silver, bronze_table=bt, silver_table=st)
    got = {r.status: r["count"] for r in spark.table(bt).groupBy("status").count().collect()}
    assert got == exp
    assert spark.table(st).count() == exp["loaded"]
    gp, lp = fresh_dir(spark, "t-genre"), fresh_dir(spark, "t-lang")
    res = repair_quarantined(spark, bronze, silver, genre_path=gp, language_path=lp)
    got = {r.status: r["count"] for r in spark.read.parquet(bronze).groupBy("status").count().collect()}
    assert got == {"loaded": exp["loaded"] + exp["quarantined"], "new": exp["new"]}
    assert spark.read.parquet(silver).where("RunTime < 0").count() == 0
    assert spark.read.parquet(lp).count() == exp["quarantined"]
    # a second repair finds nothing quarantined and adds no genre twice
    repair_quarantined(spark, bronze, silver, genre_path=gp)
    g = spark.read.parquet(gp)
    assert g.count() == g.select("genre_id").distinct().count()


def test_rebuild_is_idempotent(spark):
    raw = _raw(spark)
    once, bronze = fresh_dir(spark, "t-once"), fresh_dir(spark, "t-bronze")
    raw_to_bronze(spark, raw, once, ingest_ts="2024-01-31 12:00:00", rebuild=True)
    for _ in range(2):
        raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00", rebuild=True)
    a, b = spark.read.parquet(once), spark.read.parquet(bronze)
    assert a.count() == movie_records(spark, SF0001).count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0   # same table
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    assert spark.read.parquet(bronze).count() == 2 * movie_records(spark, SF0001).count()


def test_register_partitioned_table_recovers(spark):
    raw = _raw(spark)
    bronze = fresh_dir(spark, "t-bronze")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    use_database(spark, unique_name("movie_db"))
    name = unique_name("bronze_movie")
    register_table(spark, name, bronze)
    assert spark.table(name).count() > 0
    spark.sql("USE default")


def test_stream_two_drops_and_restart(spark):
    m = movie_records(spark, SF0001)
    raw_dir, bronze = fresh_dir(spark, "t-drops"), fresh_dir(spark, "t-sbronze")
    ckpt, name = fresh_dir(spark, "t-ckpt"), unique_name("stream")
    early = F.col("OriginalLanguage") < "FURNITURE"
    runs = []
    for i, part in enumerate((m.where(early), m.where(~early))):
        write_envelope(part, f"{raw_dir}/d{i}")
        runs.append(run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name,
                                      ingest_ts="2024-01-31 12:00:00"))
        assert spark.read.parquet(bronze).count() == (part.count() if i == 0 else m.count())
    runs.append(run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name,
                                  ingest_ts="2024-01-31 12:00:00"))
    assert spark.read.parquet(bronze).count() == m.count()
    prog = progress_rows(spark, runs).collect()
    assert sum(r.numInputRows for r in prog if r.name == name) > 0


def test_stream_batch_is_applied_once(spark):
    from strata.sources.raw import text_lines
    from strata.streaming.bronze_stream import apply_batch

    raw, bronze, ckpt = fresh_dir(spark, "t-once-raw"), fresh_dir(spark, "t-once"), fresh_dir(spark, "t-once-ckpt")
    write_envelope(movie_records(spark, SF0001), raw)
    env = text_lines(spark, raw)
    args = (bronze, ckpt, "s", "d", "2024-01-31 12:00:00")
    assert apply_batch(env, 0, *args) and not apply_batch(env, 0, *args)  # a restart hands it over again
    assert spark.read.parquet(bronze).count() == env.count()
    # names that are special in a path pattern or an URI
    odd = f"{fresh_dir(spark, 't-odd')}/a b%20[x]"
    env.limit(3).select("document").coalesce(1).write.text(odd)
    lines = text_lines(spark, odd.replace("[", "\\[").replace("]", "\\]"))
    assert apply_batch(lines, 1, *args)
    assert spark.read.parquet(bronze).count() == env.count() + 3


def test_merge_refuses_a_file_sink_folder(spark):
    import pytest

    from strata.operators.merge import merge_update_path

    path = fresh_dir(spark, "t-sink")
    spark.range(3).selectExpr("CAST(id AS STRING) movie", "'new' status", "DATE'2024-01-01' p_ingestdate").write.partitionBy(
        "p_ingestdate").parquet(path)
    spark.range(1).write.json(f"{path}/_spark_metadata")
    with pytest.raises(ValueError, match="_spark_metadata"):
        merge_update_path(spark, path, spark.range(1).selectExpr("'1' movie", "'x' outcome"), "movie", {"status": "outcome"})


def test_silver_run_reports_the_null_profile(spark):
    raw, profile = _raw(spark), {}
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    batch = bronze_to_silver(spark, bronze, silver, profile=profile)
    assert profile == {"rows": batch.count(), "complete_rows": batch.na.drop().count()}


def test_second_silver_run_changes_nothing(spark):
    exp = _expected_split()
    raw = _raw(spark)
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    bronze_to_silver(spark, bronze, silver)
    batch = bronze_to_silver(spark, bronze, silver)      # only unclassified rows are still new
    assert batch.count() == exp["new"]
    assert spark.read.parquet(silver).count() == exp["loaded"]
    got = {r.status: r["count"] for r in spark.read.parquet(bronze).groupBy("status").count().collect()}
    assert got == exp


def test_repair_recheck_loads_only_clean(spark):
    raw = _raw(spark)
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    bronze_to_silver(spark, bronze, silver)
    before = spark.read.parquet(silver).count()
    res = repair_quarantined(spark, bronze, silver, recheck=True)
    added = spark.read.parquet(silver).count() - before
    assert added == res.repaired.count()
    bad = res.repaired.where((F.col("RunTime") <= 0) | (F.col("Budget") < 1000000)
                             | F.col("RunTime").isNull() | F.col("Budget").isNull())
    assert bad.count() == 0


def test_stream_bounded_batches_with_archive(spark):
    m = movie_records(spark, SF0001)
    raw_dir, bronze = fresh_dir(spark, "t-arch-src"), fresh_dir(spark, "t-arch-bronze")
    archive, ckpt, name = fresh_dir(spark, "t-archive"), fresh_dir(spark, "t-arch-ckpt"), unique_name("s")
    write_envelope(m.repartition(5), f"{raw_dir}/d0")
    q = run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name, multiline=False,
                          max_files_per_trigger=2, archive_dir=archive,
                          ingest_ts="2024-01-31 12:00:00")
    assert len(q.recentProgress) >= 2  # bounded micro-batches
    assert spark.read.parquet(bronze).count() == m.count()


def test_silver_run_with_nothing_new_is_a_no_op(spark):
    raw = _raw(spark)
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    bronze_to_silver(spark, bronze, silver, nulls="quarantine")
    before = sorted(tuple(r) for r in spark.read.parquet(bronze).groupBy("status").count().collect())
    n_silver = spark.read.parquet(silver).count()
    batch = bronze_to_silver(spark, bronze, silver, nulls="quarantine")   # no 'new' rows left
    assert batch.count() == 0
    assert sorted(tuple(r) for r in spark.read.parquet(bronze).groupBy("status").count().collect()) == before
    assert spark.read.parquet(silver).count() == n_silver
    assert "new" not in dict(before)


def test_genre_append_has_each_id_once(spark):
    raw = _raw(spark)
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts="2024-01-31 12:00:00")
    bronze_to_silver(spark, bronze, silver)
    gp = fresh_dir(spark, "t-genre1")
    repair_quarantined(spark, bronze, silver, genre_path=gp)
    assert spark.read.parquet(gp).count() == spark.read.parquet(gp).select("genre_id").distinct().count()
