import pytest
from pyspark.sql import functions as F

from strata.plans.bronze_to_silver import bronze_to_silver
from strata.plans.raw_to_bronze import raw_to_bronze
from strata.session import fresh_dir, unique_name
from strata.sinks.batches import layer_rows
from strata.sinks.envelope import write_envelope
from strata.sources.driver_tables import movie_records
from strata.sources.raw import text_lines
from strata.streaming import medallion_stream
from strata.streaming.medallion_stream import apply_medallion_batch, run_raw_to_silver

from conftest import SF0001

AT = "2024-01-31 12:00:00"


def content(spark, bronze, silver):
    return (sorted(map(repr, layer_rows(spark, bronze).select("datasource", "ingesttime", "movie", "status", "p_ingestdate").collect())),
            sorted(map(repr, layer_rows(spark, silver).collect())))


@pytest.fixture(scope="module")
def raw(spark):
    path = fresh_dir(spark, "t-raw")
    write_envelope(movie_records(spark, SF0001).repartition(4), f"{path}/drop")
    return path


@pytest.fixture(scope="module")
def wanted(spark, raw):
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, f"{raw}/*", bronze, ingest_ts=AT)
    bronze_to_silver(spark, bronze, silver)
    return content(spark, bronze, silver)


def test_equals_the_batch_steps(spark, raw, wanted):
    bronze, silver, ckpt = (fresh_dir(spark, x) for x in ("t-bronze", "t-silver", "t-ckpt"))
    for _ in range(2):  # the second run finds nothing new
        run_raw_to_silver(spark, f"{raw}/*", bronze, silver, ckpt, "s", max_files_per_trigger=2, ingest_ts=AT)
    assert content(spark, bronze, silver) == wanted
    assert spark.read.parquet(bronze).select("p_batch").distinct().count() == 2


def test_a_batch_that_died_between_the_layers_is_written_once(spark, raw, wanted, monkeypatch):
    bronze, silver, ckpt, name = *(fresh_dir(spark, x) for x in ("t-bronze", "t-silver", "t-ckpt")), unique_name("s")
    plain, calls = medallion_stream.write_batch, []

    def dies(rows, layer, *a, **k):
        calls.append(layer)
        if len(calls) in (2, 5):
            raise RuntimeError("lost")
        plain(rows, layer, *a, **k)

    monkeypatch.setattr(medallion_stream, "write_batch", dies)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            run_raw_to_silver(spark, f"{raw}/*", bronze, silver, ckpt, name, max_files_per_trigger=2, ingest_ts=AT)
    run_raw_to_silver(spark, f"{raw}/*", bronze, silver, ckpt, name, max_files_per_trigger=2, ingest_ts=AT)
    assert content(spark, bronze, silver) == wanted


def test_replayed_batch_replaces_itself(spark, raw, wanted):
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    for _ in range(2):
        apply_medallion_batch(text_lines(spark, f"{raw}/*"), 0, bronze, silver, "s", ingest_ts=AT)
    assert content(spark, bronze, silver) == wanted
    empty = text_lines(spark, f"{raw}/*").where(F.lit(False))
    apply_medallion_batch(empty, 1, bronze, silver, "s", ingest_ts=AT)
    assert content(spark, bronze, silver) == wanted
