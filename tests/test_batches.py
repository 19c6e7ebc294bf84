import pytest
from pyspark.sql import functions as F

from strata.plans.bronze_to_silver import bronze_to_silver, complete_pending
from strata.plans.raw_to_bronze import raw_to_bronze
from strata.plans.silver_update import repair_quarantined
from strata.session import fresh_dir
from strata.sinks import batches
from strata.sinks.batches import layer_rows, pending
from strata.sinks.envelope import write_envelope
from strata.sinks.files import remove_path
from strata.sources.driver_tables import movie_records

from conftest import SF0001

AT = "2024-01-31 12:00:00"


class Died(Exception):
    pass


def dies_after(step):
    def on_step(done):
        if done == step:
            raise Died
    return on_step


@pytest.fixture(scope="module")
def raw(spark):
    path = fresh_dir(spark, "t-raw")
    write_envelope(movie_records(spark, SF0001), path)
    return path


def layers(spark, raw):
    bronze, silver = fresh_dir(spark, "t-bronze"), fresh_dir(spark, "t-silver")
    raw_to_bronze(spark, raw, bronze, ingest_ts=AT)
    return bronze, silver


def content(spark, bronze, silver):
    columns = ["Id", "RunTime", "Budget", "status"]
    return (sorted(map(repr, layer_rows(spark, silver).select(*columns).collect())),
            sorted(map(repr, spark.read.parquet(bronze).select("movie", "status").collect())))


@pytest.fixture(scope="module")
def wanted(spark, raw):
    """What one undisturbed, plain run gives."""
    bronze, silver = layers(spark, raw)
    bronze_to_silver(spark, bronze, silver)
    repair_quarantined(spark, bronze, silver)
    return content(spark, bronze, silver)


@pytest.mark.parametrize("first,second", [("staged", "appended"), ("appended", "merged"), ("merged", "staged")])
def test_interrupted_runs_equal_one_run(spark, raw, wanted, first, second):
    bronze, silver = layers(spark, raw)
    for plan, step in ((bronze_to_silver, first), (repair_quarantined, second)):
        with pytest.raises(Died):
            plan(spark, bronze, silver, repeatable=True, on_step=dies_after(step))
        plan(spark, bronze, silver, repeatable=True)
        assert pending(spark, silver) is None
    assert content(spark, bronze, silver) == wanted


def test_rows_that_arrive_in_between_are_their_own_batch(spark, raw):
    bronze, silver = layers(spark, raw)
    with pytest.raises(Died):
        bronze_to_silver(spark, bronze, silver, repeatable=True, on_step=dies_after("appended"))
    more = fresh_dir(spark, "t-more")
    write_envelope(movie_records(spark, SF0001).withColumn("Id", F.col("Id") + 10_000_000), more)
    raw_to_bronze(spark, more, bronze, ingest_ts="2024-02-01 12:00:00")
    bronze_to_silver(spark, bronze, silver, repeatable=True)
    ids = layer_rows(spark, silver).select("Id")
    assert ids.count() == ids.distinct().count()
    assert ids.where("Id >= 10000000").count() * 2 == ids.count()


def test_repair_completes_a_dead_silver_run_first(spark, raw, wanted):
    bronze, silver = layers(spark, raw)
    with pytest.raises(Died):
        bronze_to_silver(spark, bronze, silver, repeatable=True, on_step=dies_after("appended"))
    repair_quarantined(spark, bronze, silver, repeatable=True)
    assert content(spark, bronze, silver) == wanted


def test_dimensions_of_a_dead_repair_are_completed(spark, raw):
    bronze, silver = layers(spark, raw)
    genres, langs = fresh_dir(spark, "t-genres"), fresh_dir(spark, "t-langs")
    bronze_to_silver(spark, bronze, silver, repeatable=True)
    with pytest.raises(Died):
        repair_quarantined(spark, bronze, silver, genres, langs, repeatable=True, on_step=dies_after("merged"))
    assert complete_pending(spark, bronze, silver) == "repair_quarantined"
    assert complete_pending(spark, bronze, silver) is None
    repaired = layer_rows(spark, silver).where("status = 'quarantined'")
    assert spark.read.parquet(langs).count() == repaired.count() > 0
    g = spark.read.parquet(genres)
    assert g.count() == g.select("genre_id").distinct().count() > 0


def test_lost_staged_rows_are_named(spark, raw):
    bronze, silver = layers(spark, raw)
    with pytest.raises(Died):
        bronze_to_silver(spark, bronze, silver, repeatable=True, on_step=dies_after("appended"))
    remove_path(spark, pending(spark, silver)["staged"])
    with pytest.raises(RuntimeError, match="staged rows are gone"):
        bronze_to_silver(spark, bronze, silver, repeatable=True)


def test_record_is_hidden_and_layer_keeps_its_columns(spark, raw):
    bronze, silver = layers(spark, raw)
    with pytest.raises(Died):
        bronze_to_silver(spark, bronze, silver, repeatable=True, on_step=dies_after("appended"))
    rows = spark.read.parquet(silver)
    assert rows.columns[-1] == batches.BATCH and "value" not in rows.columns
    assert len(layer_rows(spark, silver).columns) == 21
    with pytest.raises(ValueError):
        bronze_to_silver(spark, bronze, silver, repeatable=True, rebuild_silver=True)
