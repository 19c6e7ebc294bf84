from pyspark.sql import functions as F

from strata import api
from strata.session import fresh_dir
from strata.sinks.staging import stage
from strata.sinks.envelope import write_envelope
from strata.sources.driver_tables import activity_records, movie_records, user_lookup
from strata.schemas import BRONZE_WRITE_ORDER

from conftest import SF0001


def test_source_style_flow(spark):
    raw = fresh_dir(spark, "a-raw")
    write_envelope(movie_records(spark, SF0001), raw)
    bronze = fresh_dir(spark, "a-bronze")
    api.transform_raw(api.read_batch_raw(spark, raw), ingest_ts="2024-01-31 12:00:00") \
        .select(*BRONZE_WRITE_ORDER).write.partitionBy("p_ingestdate").parquet(bronze)
    new = api.read_batch_bronze(spark, bronze)
    silver = stage(spark, api.transform_bronze(new), "a-batch")  # pin the batch before updates
    clean, bad = api.generate_clean_and_quarantine_dataframes(silver)
    s = fresh_dir(spark, "a-silver")
    api.batch_writer(clean, "p_ingestdate", exclude_columns=["movie"]).save(s)
    assert api.update_bronze_table_status(spark, bronze, clean, "loaded")
    assert api.update_bronze_table_status(spark, bronze, bad, "quarantined")
    got = {r.status: r["count"] for r in spark.read.parquet(bronze).groupBy("status").count().collect()}
    assert got["loaded"] == clean.count() == spark.read.parquet(s).count()
    assert got["quarantined"] == bad.count()
    assert got["new"] == silver.count() - clean.count() - bad.count()


def test_landing_api(spark):
    landing, raw = fresh_dir(spark, "a-landing"), fresh_dir(spark, "a-landed")
    assert api.prepare_activity_data(spark, activity_records(spark, SF0001), landing, tz="UTC")
    assert api.ingest_classic_data(spark, landing, raw, hours=10, tie_breaker="event_id")
    assert spark.read.parquet(landing).count() == activity_records(spark, SF0001).count() - 100


def test_repair_quarantined_records(spark):
    bronze = fresh_dir(spark, "a-qbronze")
    ev = activity_records(spark, SF0001).select(
        F.to_json(F.struct(F.col("event_id"), F.col("name").cast("bigint").alias("device_id"))).alias("movie"),
        F.lit("quarantined").alias("status"), F.lit("2024-01-31").cast("date").alias("p_ingestdate"))
    ev.write.partitionBy("p_ingestdate").parquet(bronze)
    users = fresh_dir(spark, "a-users")
    user_lookup(spark, SF0001).write.parquet(users)

    def parse(df):
        return df.select(F.from_json("movie", "event_id BIGINT, device_id BIGINT").alias("j")).select("j.*")

    out = api.repair_quarantined_records(
        spark, bronze, users, {"event_id": F.col("q.event_id"), "device_id": F.col("u.device_id").cast("int")},
        parse=parse)
    assert out.count() == activity_records(spark, SF0001).count()
