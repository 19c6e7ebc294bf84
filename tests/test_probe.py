"""J2 on a Bronze that stores the digest: the probe reads no text and skips row groups."""

import pytest
from pyspark.sql import functions as F

from strata.functions.keys import bloom_options, digest
from strata.operators import merge
from strata.operators.merge import digest_filter, merge_update_path
from strata.plans.raw_to_bronze import raw_to_bronze, stores_digest
from strata.session import fresh_dir
from strata.sinks.envelope import write_envelope

AT = "2024-01-31 12:00:00"


def bronze(spark, n=20_000, dates=4):
    path = fresh_dir(spark, "t-probe")
    rows = spark.range(n).select(
        F.concat(F.lit("record "), F.col("id").cast("string")).alias("movie"), F.lit("new").alias("status"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % dates).cast("int")).alias("p_ingestdate"))
    rows = rows.withColumn("movie_digest", digest("movie"))
    (rows.repartition("p_ingestdate").write.options(**bloom_options(rows.columns, "movie"))
     .option("parquet.block.size", 16 * 1024).partitionBy("p_ingestdate").parquet(path))
    return path


def leaf(df):
    """The scan that ran: its description and the rows that it gave out."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while True:
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        elif node.children().size():
            node = node.children().head()
        elif "Stage" in node.getClass().getSimpleName():
            node = node.plan()
        else:
            return node.toString(), node.metrics().get("numOutputRows").get().value()


def test_probe_reads_digests_of_few_row_groups(spark):
    path = bronze(spark)
    keys = spark.createDataFrame([("record 17",), ("record 4242",), ("none such",)], "movie string")
    target = merge._with_digest(spark.read.parquet(path), ["movie"], True)
    probe = merge._probe(target, merge.merge_source(keys, "movie", {}), ["movie"], ["p_ingestdate"])
    text, given = leaf(probe)
    assert "ReadSchema: struct<movie_digest:bigint>" in text and "movie_digest" in text.split("PushedFilters")[1]
    assert 2 <= given < 20_000 / 3  # whole row groups, and few of them
    assert {str(r[0]) for r in probe.collect()} == {"2024-01-02", "2024-01-03"}


def test_few_keys_and_many_keys_merge_alike(spark, monkeypatch):
    keys = spark.range(0, 300, 3).select(F.concat(F.lit("record "), F.col("id").cast("string")).alias("movie"),
                                         F.lit("loaded").alias("outcome"))
    done = []
    for most in (merge.PROBE_KEYS, 0):
        monkeypatch.setattr(merge, "PROBE_KEYS", most)
        path = bronze(spark, 2000)
        merge_update_path(spark, path, keys, "movie", {"status": "outcome"}, sort_within=("status",))
        done.append(sorted(map(tuple, spark.read.parquet(path).select("movie", "status", "movie_digest", "p_ingestdate").collect())))
    assert done[0] == done[1] and sum(r[1] == "loaded" for r in done[0]) == 100


def test_a_rewrite_keeps_the_digest_sorted_with_bloom_filters(spark):
    import glob

    import pyarrow.parquet as pq

    path = bronze(spark, 2000, dates=1)
    keys = spark.createDataFrame([("record 17",)], "movie string")
    merge_update_path(spark, path, keys.withColumn("s", F.lit("loaded")), "movie", {"status": "s"}, sort_within=("status",))
    files = glob.glob(path.removeprefix("file:") + "/*/*.parquet")
    for f in files:
        t = pq.read_table(f)
        rows = list(zip(t["status"].to_pylist(), t["movie_digest"].to_pylist(), strict=True))
        assert rows == sorted(rows)
    df = spark.read.parquet(path).where(F.col("movie_digest") == 1).select("movie_digest")
    assert leaf(df)[1] == 0  # no row group may hold it


def test_digest_filter(spark):
    df = spark.range(200).select(F.col("id").alias("d"))
    for values in ([], [3], list(range(0, 150, 2)), [1, 500]):
        assert sorted(r.d for r in df.where(digest_filter("d", values)).collect()) == [v for v in values if v < 200]


def test_all_rows_of_a_table_store_the_digest_or_none(spark):
    raw = fresh_dir(spark, "t-raw")
    write_envelope(spark.range(3).select(F.col("id").alias("Id")), raw)
    old, new = fresh_dir(spark, "t-old"), fresh_dir(spark, "t-new")
    raw_to_bronze(spark, raw, old, ingest_ts=AT, store_digest=False)
    raw_to_bronze(spark, raw, old, ingest_ts=AT)  # goes on as it is
    assert len(spark.read.parquet(old).columns) == 5
    for _ in range(2):
        raw_to_bronze(spark, raw, new, ingest_ts=AT)
    assert spark.read.parquet(new).where("movie_digest IS NULL OR movie_digest <> xxhash64(movie)").count() == 0
    with pytest.raises(ValueError):
        raw_to_bronze(spark, raw, old, ingest_ts=AT, store_digest=True)
    assert stores_digest(spark, old, None) is False
    raw_to_bronze(spark, raw, old, ingest_ts=AT, rebuild=True)
    assert stores_digest(spark, old, None) is True
