"""Registered queries and their DuckDB oracles.

Every query reads the driver's tables whole, derives the layer inputs from
them with Spark (envelope files, Bronze, landing backlog) in fresh folders
under the shared scratch root, runs the library operator and returns a
DataFrame whose columns match the oracle's by name.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.api import repair_quarantined_records_typed, update_bronze_table_status
from strata.functions.metadata import ingest_metadata
from strata.functions.records import parse_records, transform_bronze
from strata.operators import dimensions as dim
from strata.operators.dedupe import distinct_rows
from strata.operators.landing import land_next_batch, land_next_batches, prepare_activity, prepare_activity_path
from strata.operators.landing_cursor import Landing, land_all
from strata.operators.merge import merge_delete_path, merge_update
from strata.operators.quality import (
    OUTCOME,
    assert_schema,
    classify,
    drop_incomplete,
    null_profile,
    split,
)
from strata.operators.repair import repair_by_lookup
from strata.plans.bronze_to_silver import bronze_to_silver, classified_batch
from strata.plans.raw_to_bronze import raw_to_bronze
from strata.plans.silver_update import repair_quarantined
from strata.schemas import BRONZE_SCHEMA, BRONZE_WRITE_ORDER, SILVER_COLUMNS
from strata.session import fresh_dir, unique_name
from strata.sinks.batches import layer_rows
from strata.sinks.catalog import register_table, use_database
from strata.sinks.envelope import write_envelope, write_envelope_documents
from strata.sinks.staging import stage
from strata.sources.driver_tables import activity_records, movie_records, table, user_lookup
from strata.sources.raw import peek_raw, raw_inventory, raw_rejects, read_raw, text_lines
from strata.sources.tables import read_by_status
from strata.streaming.bronze_stream import progress_rows, run_raw_to_bronze
from strata.streaming.medallion_stream import apply_medallion_batch, run_raw_to_silver

INGEST_TS = "2024-01-31 12:00:00"
INGEST_DATE = "2024-01-31"
LATER_TS, LATER_DATE = "2030-02-01 12:00:00", "2030-02-01"
DATASOURCE = "raw-files"
RECORDS_PER_FILE = 2000
REC_COLS = ["Id", "Title", "Budget", "RunTime"]

Query = Callable[[SparkSession, str], DataFrame]


# --- shared steps -------------------------------------------------------------

def _envelope(spark: SparkSession, sf: str, multiline: bool = False) -> str:
    """Envelope files of ``m``: JSON lines, or documents of many records for the multi-line reader."""
    path = fresh_dir(spark, "raw")
    if multiline:
        write_envelope_documents(movie_records(spark, sf), path, records_per_file=RECORDS_PER_FILE)
    else:
        write_envelope(movie_records(spark, sf), path)
    return path


def _parsed(spark: SparkSession, sf: str, multiline: bool = False) -> DataFrame:
    """Envelope files written from ``m``, read back (S1) and parsed."""
    return parse_records(read_raw(spark, _envelope(spark, sf, multiline), multiline=multiline), keep=())


def _bronze(spark: SparkSession, sf: str) -> str:
    path = fresh_dir(spark, "bronze")
    raw_to_bronze(spark, _envelope(spark, sf), path, datasource=DATASOURCE, ingest_ts=INGEST_TS,
                  multiline=False)
    return path


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("Id", F.get_json_object("movie", "$.Id").cast("bigint"))


def _landing(spark: SparkSession, sf: str) -> str:
    path = fresh_dir(spark, "landing")
    prepare_activity_path(spark, activity_records(spark, sf), path, tz="UTC", tie_breaker="event_id")
    return path


# --- queries ------------------------------------------------------------------

def q_json_envelope_read(spark, sf):
    """The reference's reader: one multi-line document per file."""
    return _parsed(spark, sf, multiline=True).select(*REC_COLS, "OriginalLanguage", "ReleaseDate")


def q_json_envelope_read_lines(spark, sf):
    """The JSON-lines layout of the same envelopes (splittable)."""
    return _parsed(spark, sf, multiline=False).select(*REC_COLS, "OriginalLanguage", "ReleaseDate")


def _permissive_texts(spark, sf):
    """One record text per order; its shape is chosen by the order priority."""
    o = table(spark, sf, "orders")
    budget = F.col("o_totalprice") * 10
    pr = F.col("o_orderpriority")

    def js(*pairs):
        return F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))

    text = (
        F.when(pr == "1-URGENT", js(("Id", F.col("o_orderkey")), ("Budget", budget),
                                    ("RunTime", F.col("o_custkey"))))
        .when(pr == "2-HIGH", F.concat(F.lit("{bad"), F.col("o_orderkey").cast("string")))
        .when(pr == "3-MEDIUM", js(("Id", F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))),
                                   ("Budget", budget), ("RunTime", F.col("o_custkey"))))
        .when(pr == "4-NOT SPECIFIED", js(("id", F.col("o_orderkey")), ("Budget", budget),
                                          ("RunTime", F.col("o_custkey"))))
        .otherwise(js(("Id", F.col("o_orderkey")), ("Budget", budget),
                      ("RunTime", F.col("o_custkey") + F.lit(0.5))))
    )
    return o.select(F.col("o_orderkey"), text.alias("movie"))


def q_json_permissive(spark, sf):
    src = _permissive_texts(spark, sf)
    return parse_records(src, keep=("o_orderkey",)).select("o_orderkey", "Id", "Budget", "RunTime")


def q_json_corrupt(spark, sf):
    """X1 with a corrupt-record column: malformed text and bad fields are flagged."""
    p = parse_records(_permissive_texts(spark, sf), keep=("o_orderkey",), corrupt_column="_corrupt")
    return p.select("o_orderkey", F.col("_corrupt").isNotNull().alias("corrupt"))


def q_ingest_metadata(spark, sf):
    raw = read_raw(spark, _envelope(spark, sf, multiline=True), multiline=True)
    b = assert_schema(ingest_metadata(raw, DATASOURCE, INGEST_TS), BRONZE_SCHEMA)
    return _with_id(b).select("Id", "datasource", "status", "p_ingestdate")


def q_bronze_write_read(spark, sf):
    raw = _envelope(spark, sf)
    path = fresh_dir(spark, "bronze")
    name = unique_name("bronze_movie")
    for _ in range(2):  # a rebuild run twice gives the table of one run
        raw_to_bronze(spark, raw, path, table=name, datasource=DATASOURCE,
                      ingest_ts=INGEST_TS, rebuild=True, multiline=False)
    b = read_by_status(spark, name, "new")
    return b.groupBy("status", "p_ingestdate").agg(F.count(F.lit(1)).alias("n"))


def q_silver_project(spark, sf):
    b = _bronze(spark, sf)
    s = fresh_dir(spark, "silver")
    name = unique_name("silver_movie")
    bronze_to_silver(spark, b, s, silver_table=name)
    silver = spark.table(name)
    assert [f.name for f in silver.schema.fields] == SILVER_COLUMNS
    return silver.select(*REC_COLS, "OriginalLanguage", "ReleaseDate", "status", "p_ingestdate")


def _split_part(i):
    def q(spark, sf):
        return split(_parsed(spark, sf))[i].select(*REC_COLS)
    return q


def q_null_profile(spark, sf):
    cols = [*REC_COLS, "OriginalLanguage", "ReleaseDate"]
    p = _parsed(spark, sf).select(*cols)
    prof = null_profile(p)
    rows = prof.select(F.lit("rows").alias("metric"), F.col("n_rows").alias("value"))
    complete = prof.select(F.lit("complete").alias("metric"), F.col("n_complete").alias("value"))
    dropped = drop_incomplete(p).agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("after_na_drop").alias("metric"), "value")
    return rows.unionByName(complete).unionByName(dropped)


def q_merge_status(spark, sf):
    b = _bronze(spark, sf)
    bronze_to_silver(spark, b, fresh_dir(spark, "silver"))
    return _with_id(spark.read.parquet(b)).select("Id", "status")


def q_merge_status_digest(spark, sf):
    """C1 -> C2 on the Bronze layout with a stored record digest (touched scan on 8 bytes/row)."""
    path = fresh_dir(spark, "bronze-digest")
    raw_to_bronze(spark, _envelope(spark, sf), path, datasource=DATASOURCE, ingest_ts=INGEST_TS,
                  multiline=False, store_digest=True)
    bronze_to_silver(spark, path, fresh_dir(spark, "silver"))
    return _with_id(spark.read.parquet(path)).select("Id", "status")


def q_merge_dup_source(spark, sf):
    b = spark.read.parquet(_bronze(spark, sf))
    target = b.unionByName(b)                        # every key twice in the target
    decided = classified_batch(b).select("movie", OUTCOME)
    source = decided.unionByName(decided)            # and twice in the source
    out = merge_update(target, source.where(F.col(OUTCOME) != "new"), "movie", {"status": OUTCOME})
    return _with_id(out).select("Id", "status")


def q_merge_delete(spark, sf):
    landing = _landing(spark, sf)
    e = table(spark, sf, "events")
    doomed = prepare_activity(activity_records(spark, sf), tz="UTC").join(
        e.where((F.col("event_type") == "click") | (F.dayofmonth("ts") == 1)).select("event_id"),
        "event_id", "left_semi")
    merge_delete_path(spark, landing, doomed, ["name", "time"], partition_by=("month", "day"))
    return spark.read.parquet(landing).select("event_id")


def q_prepare_activity(spark, sf):
    return spark.read.parquet(_landing(spark, sf)).select(
        "event_id", "name", "time", "day", "month", "hour")


def q_land_next_batch(spark, sf):
    landing = _landing(spark, sf)
    schema = spark.read.parquet(landing).schema
    out = land_next_batch(spark, landing, fresh_dir(spark, "landed"), hours=10,
                          tie_breaker="event_id")
    return spark.read.schema(schema).json(out).select("event_id", "time", "day", "month", "hour")


def q_land_drain(spark, sf):
    landing = _landing(spark, sf)
    schema = spark.read.parquet(landing).schema
    raw_dir = fresh_dir(spark, "landed")
    parts = []
    for i in range(1, 4):
        out = land_next_batch(spark, landing, raw_dir, hours=10, tie_breaker="event_id",
                              batch_name=f"batch-{i}")
        parts.append(spark.read.schema(schema).json(out).select(
            "event_id", F.lit(i).alias("batch")))
    left = spark.read.parquet(landing).select("event_id", F.lit(0).alias("batch"))
    out = left
    for p in parts:
        out = out.unionByName(p)
    return out


def _repaired(spark, sf, **kw):
    b = _bronze(spark, sf)
    s = fresh_dir(spark, "silver")
    bronze_to_silver(spark, b, s)
    res = repair_quarantined(spark, b, s, **kw)
    return b, s, res


def q_repair_abs(spark, sf):
    _, s, _ = _repaired(spark, sf)
    return spark.read.parquet(s).where(F.col("status") == "quarantined").select("Id", "RunTime")


def q_repair_lookup(spark, sf):
    e = table(spark, sf, "events").alias("q")
    proj = {
        "event_id": F.col("q.event_id"),
        "device_id": F.col("u.device_id").cast("int"),
        "name": F.col("q.user_id").cast("string"),
        "p_eventdate": F.col("q.ts").cast("date"),
    }
    return repair_by_lookup(e, user_lookup(spark, sf), "user_id", "user_id", proj)


def q_genre_lookup(spark, sf):
    return dim.genre_lookup(_parsed(spark, sf))


def q_genre_junction(spark, sf):
    return dim.genre_junction(_parsed(spark, sf))


def q_genre_append_new(spark, sf):
    existing = table(spark, sf, "nation").where(F.col("n_regionkey") == 0).select(
        F.col("n_nationkey").alias("genre_id"), F.col("n_name").alias("genre_name"))
    return dim.append_new_keys(dim.genre_lookup(_parsed(spark, sf)), existing, "genre_id")


def q_languages(spark, sf):
    lp = fresh_dir(spark, "languages")
    _repaired(spark, sf, language_path=lp)
    return spark.read.parquet(lp)


def q_languages_distinct(spark, sf):
    lp = fresh_dir(spark, "languages")
    _repaired(spark, sf, language_path=lp, distinct_languages=True)
    return spark.read.parquet(lp)


def q_genre_table(spark, sf):
    gp = fresh_dir(spark, "genres")
    _repaired(spark, sf, genre_path=gp)
    return spark.read.parquet(gp)


def q_dedupe_all(spark, sf):
    b = spark.read.parquet(_bronze(spark, sf))
    out = transform_bronze(b.unionByName(b))
    return out.select(*REC_COLS, "OriginalLanguage", "ReleaseDate")


def q_dedupe_rows(spark, sf):
    p = _parsed(spark, sf).select(*REC_COLS)
    return distinct_rows(p.unionByName(p))


def q_medallion_e2e(spark, sf):
    b, s, _ = _repaired(spark, sf)
    bronze = spark.read.parquet(b).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    silver = spark.read.parquet(s).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return (bronze.select(F.lit("bronze").alias("layer"), "status", "n")
            .unionByName(silver.select(F.lit("silver").alias("layer"), "status", "n")))


def _stream(spark, sf):
    m = movie_records(spark, sf)
    raw_dir = fresh_dir(spark, "raw-drops")
    bronze = fresh_dir(spark, "bronze")
    ckpt = fresh_dir(spark, "stream-ckpt")
    name = unique_name("raw_to_bronze")
    runs = []
    early = F.coalesce(F.col("OriginalLanguage") < "FURNITURE", F.lit(False))
    for i, part in enumerate((m.where(early), m.where(~early)), start=1):
        write_envelope(part, f"{raw_dir}/drop-{i}")
        runs.append(run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name, multiline=False,
                                      datasource=DATASOURCE, ingest_ts=INGEST_TS))
    runs.append(run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name, multiline=False,
                                  datasource=DATASOURCE, ingest_ts=INGEST_TS))  # restart: nothing new
    return bronze, runs


def q_stream_bronze(spark, sf):
    bronze, _ = _stream(spark, sf)
    return _with_id(spark.read.parquet(bronze)).select("Id", "status", "p_ingestdate")


def q_stream_progress(spark, sf):
    """R2 over more micro-batches than the session retains progress reports for (100)."""
    raw_dir, ckpt = fresh_dir(spark, "raw-drops"), fresh_dir(spark, "stream-ckpt")
    write_envelope(movie_records(spark, sf).repartition(104, "Id"), f"{raw_dir}/drop")
    run = run_raw_to_bronze(spark, f"{raw_dir}/*", fresh_dir(spark, "bronze"), ckpt, unique_name("progress"),
                            datasource=DATASOURCE, ingest_ts=INGEST_TS, max_files_per_trigger=1)
    return progress_rows(spark, [run]).agg(F.sum("numInputRows").alias("envelopes"),
                                           (F.count(F.lit(1)) > 100).alias("over_100"))


def q_stream_to_silver(spark, sf):
    """R1 twice, on two dates, C2 after each, then C3: the stream's Bronze stays a plain table."""
    m, raw_dir = movie_records(spark, sf), fresh_dir(spark, "raw-drops")
    bronze, silver, ckpt = fresh_dir(spark, "bronze"), fresh_dir(spark, "silver"), fresh_dir(spark, "stream-ckpt")
    name, early = unique_name("raw_to_bronze"), F.coalesce(F.col("OriginalLanguage") < "FURNITURE", F.lit(False))
    for i, (part, at) in enumerate(((m.where(early), INGEST_TS), (m.where(~early), LATER_TS)), start=1):
        write_envelope(part, f"{raw_dir}/drop-{i}")
        run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, ckpt, name, datasource=DATASOURCE, ingest_ts=at)
        bronze_to_silver(spark, bronze, silver)
    repair_quarantined(spark, bronze, silver)
    return _with_id(spark.read.parquet(bronze)).select("Id", "status", "p_ingestdate")


def q_raw_rejects(spark, sf):
    """S1 with documents cut short: each document is accepted or told as rejected."""
    o, path = table(spark, sf, "orders"), fresh_dir(spark, "raw")
    whole = F.concat(F.lit('{"movie":[{"Id":'), F.col("o_orderkey").cast("string"), F.lit("}]}"))
    short = F.col("o_orderpriority") == "2-HIGH"
    o.select(F.when(short, F.substring(whole, 1, 14)).otherwise(whole).alias("value")).write.text(path)
    accepted = read_raw(spark, path, rejects="skip").agg(F.count(F.lit(1)).alias("n"))
    rejected = raw_rejects(spark, path).agg(F.count(F.lit(1)).alias("n"))
    return (accepted.select(F.lit("accepted").alias("kind"), "n")
            .unionByName(rejected.select(F.lit("rejected").alias("kind"), "n")))


def _odd_lines(spark, sf):
    """One line per order: a document, or by priority a broken one, two, one with more text, one of another shape."""
    o = table(spark, sf, "orders")
    k, pr = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    one = F.concat(F.lit('{"movie":[{"Id":'), k, F.lit("}]}"))
    return o.select(F.when(pr == "1-URGENT", F.concat(one, one))
                    .when(pr == "2-HIGH", F.substring(one, 1, 14))
                    .when(pr == "3-MEDIUM", F.concat(one, F.lit(" #"), k))
                    .when(pr == "4-NOT SPECIFIED", F.concat(F.lit('{"movie":'), k, F.lit("}")))
                    .otherwise(one).alias("value"))


def _kinds(accepted, rejected):
    return (accepted.groupBy(F.lit("accepted").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
            .unionByName(rejected.groupBy(F.col("reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))))


def q_raw_one_document(spark, sf):
    """Each line holds exactly one document or is told, with the reason."""
    path = fresh_dir(spark, "raw")
    _odd_lines(spark, sf).write.text(path)
    return _kinds(read_raw(spark, path, rejects="skip"), raw_rejects(spark, path))


def q_raw_one_document_files(spark, sf):
    """The same for the multi-line reader: one file per nation, by region with one document, two, one with more text, a cut one."""
    path = fresh_dir(spark, "raw")
    n = table(spark, sf, "nation")
    one = F.concat(F.lit('{"movie":\n [{"Id":'), F.col("n_nationkey").cast("string"), F.lit("}]}"))
    bodies = n.select(F.when(F.col("n_regionkey") == 0, F.concat(one, F.lit("\n"), one))
                      .when(F.col("n_regionkey") == 1, F.concat(one, F.lit(" trailing")))
                      .when(F.col("n_regionkey") == 2, F.substring(one, 1, 14)).otherwise(one).alias("value"))
    bodies.write.option("maxRecordsPerFile", 1).text(path)
    return _kinds(read_raw(spark, path, rejects="skip", multiline=True), raw_rejects(spark, path, multiline=True))


def q_stream_one_document(spark, sf):
    """R1 over the same lines: the stream takes what the batch reader takes."""
    raw_dir, bronze = fresh_dir(spark, "raw-drops"), fresh_dir(spark, "bronze")
    _odd_lines(spark, sf).write.text(f"{raw_dir}/drop")
    run_raw_to_bronze(spark, f"{raw_dir}/*", bronze, fresh_dir(spark, "stream-ckpt"), unique_name("odd"),
                      datasource=DATASOURCE, ingest_ts=INGEST_TS, max_files_per_trigger=2, rejects="skip")
    return _with_id(spark.read.parquet(bronze)).select("Id", "status", "p_ingestdate")


class _Died(Exception):
    """Stands for a driver that is lost in the middle of a step."""


def _dies_after(step):
    def on_step(done):
        if done == step:
            raise _Died(step)
    return on_step


def q_silver_repeatable(spark, sf):
    """C2 and C3 that die between append and merge, and after the merge, and are run again."""
    b, s = _bronze(spark, sf), fresh_dir(spark, "silver")
    genres = fresh_dir(spark, "genres")
    for plan, how in ((bronze_to_silver, {}), (repair_quarantined, {"genre_path": genres})):
        for step in ("staged", "appended", "merged"):
            with contextlib.suppress(_Died):
                plan(spark, b, s, repeatable=True, on_step=_dies_after(step), **how)
        plan(spark, b, s, repeatable=True, **how)
    silver = layer_rows(spark, s).select(F.lit("silver").alias("layer"), "Id", "status")
    bronze = _with_id(spark.read.parquet(b)).select(F.lit("bronze").alias("layer"), "Id", "status")
    genre = spark.read.parquet(genres).select(F.lit("genre").alias("layer"), F.col("genre_id").cast("long").alias("Id"),
                                              F.lit("").alias("status"))
    return silver.unionByName(bronze).unionByName(genre)


def _shared_landing(spark, sf):
    """A backlog in which many rows share name and time and some have none."""
    a = activity_records(spark, sf)
    shared = a.select("event_id", F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 5).cast("string")).alias("name"),
                      F.when(F.col("event_id") % 11 != 0, F.col("time") - F.col("time") % 3600).alias("time"))
    path = fresh_dir(spark, "landing")
    prepare_activity_path(spark, shared, path, tz="UTC", tie_breaker="event_id")
    return path


def _landed(spark, sf, batches):
    """``(event_id, batch, part of)`` of the batches' folders, the batch's number in its name."""
    kind = table(spark, sf, "events").schema["event_id"].dataType.simpleString()
    rows = spark.read.schema(f"event_id {kind}").json(batches)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch-(\d+)/", 1).cast("int")
    return rows.select("event_id", number.alias("batch"))


def q_land_cursor_drain(spark, sf):
    """C4 by cursor: the whole backlog in 20 batches, no row rewritten."""
    n = table(spark, sf, "events").count()
    batches = land_all(spark, _shared_landing(spark, sf), fresh_dir(spark, "landed"), hours=-(-n // 200),
                       tie_breaker="event_id")
    return _landed(spark, sf, batches)


def q_land_half(spark, sf):
    """O1 for half of the backlog as one batch, written by many tasks; the other half remains."""
    n = table(spark, sf, "events").count()
    landing = Landing(spark, _shared_landing(spark, sf), "event_id")
    out = landing.land(fresh_dir(spark, "landed"), hours=n // 20)
    left = landing.remaining().select("event_id", F.lit(0).alias("batch"))
    return _landed(spark, sf, [out]).unionByName(left)


def q_stream_medallion(spark, sf):
    """R1 -> C2 in one micro-batch each, one handed over again, then C3."""
    raw_dir, ckpt, name = fresh_dir(spark, "raw-drops"), fresh_dir(spark, "stream-ckpt"), unique_name("medallion")
    bronze, silver = fresh_dir(spark, "bronze"), fresh_dir(spark, "silver")
    write_envelope(movie_records(spark, sf).repartition(6, "Id"), f"{raw_dir}/drop")
    how = {"datasource": DATASOURCE, "ingest_ts": INGEST_TS}
    run_raw_to_silver(spark, f"{raw_dir}/*", bronze, silver, ckpt, name, max_files_per_trigger=2, **how)
    # the first micro-batch once more, as after a crash before the stream's own commit
    log = spark.read.text(f"{ckpt}/sources/0/0").where("value LIKE '{%'")
    again = [r[0] for r in log.select(F.get_json_object("value", "$.path")).collect()]
    apply_medallion_batch(text_lines(spark, again), 0, bronze, silver, name, **how)
    repair_quarantined(spark, bronze, silver, repeatable=True)
    return (_with_id(spark.read.parquet(bronze)).select(F.lit("bronze").alias("layer"), "Id", "status")
            .unionByName(layer_rows(spark, silver).select(F.lit("silver").alias("layer"), "Id", "status")))


def q_repair_catalog_lookup(spark, sf):
    """Quarantined Bronze records joined with a catalog table, typed by try_cast, all counted."""
    e, path, bronze = table(spark, sf, "events"), fresh_dir(spark, "raw"), fresh_dir(spark, "bronze")
    number = F.col("event_id").cast("string")
    device = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), number)).when(
        F.col("event_id") % 7 != 0, F.col("user_id").cast("string"))
    heart = F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).when(F.col("event_id") % 11 != 0, number)
    records = e.select("event_id", device.alias("device_id"), heart.alias("heartrate"))
    write_envelope(records, path)
    name, users = unique_name("bronze_event"), unique_name("user_lookup")
    raw_to_bronze(spark, path, bronze, table=name, datasource=DATASOURCE, ingest_ts=INGEST_TS)
    update_bronze_table_status(spark, bronze, stage(spark, read_by_status(spark, bronze), "all"), "quarantined")
    register_table(spark, name, bronze)
    found = fresh_dir(spark, "users")
    user_lookup(spark, sf).where("user_id % 4 <> 0").write.parquet(found)
    register_table(spark, users, found, partitioned=False)
    shape = "event_id BIGINT, device_id STRING, heartrate STRING"
    done = repair_quarantined_records_typed(spark, name, users, {
        "event_id": (F.col("q.event_id"), "bigint"), "device_id": (F.col("u.device_id"), "int"),
        "heartrate": (F.col("q.heartrate"), "int"), "p_eventdate": (F.col("q.p_ingestdate"), "date")},
        parse=lambda q: parse_records(q, schema=shape))
    assert done.counts == {"repaired": done.repaired.count(), "rejected": done.rejected.count(),
                           "unmatched": done.unmatched.count()}
    none = F.lit(None)
    return (done.repaired.select(F.lit("repaired").alias("kind"), "event_id", "device_id", "heartrate")
            .unionByName(done.rejected.select(F.concat_ws(":", F.lit("rejected"), "reasons").alias("kind"), F.col("q.event_id").alias("event_id"),
                                              none.cast("int").alias("device_id"), none.cast("int").alias("heartrate")))
            .unionByName(done.unmatched.select(F.lit("unmatched").alias("kind"), "event_id",
                                               none.cast("int").alias("device_id"), none.cast("int").alias("heartrate"))))


def q_activity_session_zone(spark, sf):
    """X8 in the session's zone, over a year with both clock changes (texts of one hour repeat)."""
    e = table(spark, sf, "events")
    year = F.lit(1_704_067_200) + (F.col("event_id") * 7919 * 61) % 31_536_000
    df = e.select("event_id", year.cast("long").alias("time"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        return stage(spark, prepare_activity(df), "activity")  # evaluated in that zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def q_ingest_clock(spark, sf):
    """Without a given time, both columns come from one instant, the query's."""
    b = ingest_metadata(read_raw(spark, _envelope(spark, sf)), DATASOURCE)
    return b.agg(F.count(F.lit(1)).alias("n"), (F.countDistinct("ingesttime") == 1).alias("one_instant"),
                 F.bool_and(F.col("ingesttime").cast("date") == F.col("p_ingestdate")).alias("same_date"))


def q_catalog_database(spark, sf):
    """K9 and K8: a database, tables in it registered anew by two C2 and C3 runs without being dropped."""
    db, old = unique_name("movie_db"), spark.catalog.currentDatabase()
    use_database(spark, db)
    try:
        bronze, silver, genres = (fresh_dir(spark, x) for x in ("bronze", "silver", "genres"))
        m = movie_records(spark, sf)
        for part, at in ((m.where("Id % 2 = 0"), INGEST_TS), (m.where("NOT Id % 2 = 0 OR Id IS NULL"), LATER_TS)):
            path = fresh_dir(spark, "raw")
            write_envelope(part, path)
            raw_to_bronze(spark, path, bronze, table=f"{db}.bronze_movie", datasource=DATASOURCE, ingest_ts=at)
            bronze_to_silver(spark, bronze, silver, bronze_table=f"{db}.bronze_movie", silver_table=f"{db}.silver_movie")
            repair_quarantined(spark, bronze, silver, genre_path=genres, genre_table=f"{db}.genre",
                               silver_table=f"{db}.silver_movie")
        count = lambda t, by: spark.table(f"{db}.{t}").groupBy(F.lit(t).alias("name"), F.col(by).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n"))
        return stage(spark, count("bronze_movie", "p_ingestdate").unionByName(count("silver_movie", "p_ingestdate"))
                     .unionByName(count("genre", "genre_id")), "catalog-counts")
    finally:
        spark.catalog.setCurrentDatabase(old)


def q_merge_few_keys(spark, sf):
    """J2 with few keys: the probe asks the stored digest for each, over all dates."""
    path, bronze = fresh_dir(spark, "raw"), fresh_dir(spark, "bronze")
    m = movie_records(spark, sf)
    for i, at in enumerate((INGEST_TS, LATER_TS)):
        write_envelope(m.where(F.col("Id") % 2 == i), f"{path}-{i}")
        raw_to_bronze(spark, f"{path}-{i}", bronze, datasource=DATASOURCE, ingest_ts=at)
    few = stage(spark, _with_id(read_by_status(spark, bronze)).where("Id % 2000 = 1").select("movie"), "few")
    update_bronze_table_status(spark, bronze, few, "loaded")
    return _with_id(spark.read.parquet(bronze)).select("Id", "status", "p_ingestdate")


def q_merge_multi_date(spark, sf):
    """C2 and C3 on a Bronze of many ingest dates, one NULL, with records repeated on a later date."""
    text = F.to_json(F.struct("Id", "Title", "Budget", "RunTime", "OriginalLanguage", "ReleaseDate", "genres"))
    m = movie_records(spark, sf)
    day = F.when(F.col("Id") % 50 == 0, F.lit(None)).otherwise(F.trunc(F.col("ReleaseDate").cast("date"), "month"))
    rows = m.select("Id", text.alias("movie"), day.cast("date").alias("day"))
    again = rows.where(F.col("Id") % 4 == 0).withColumn("day", F.lit(LATER_DATE).cast("date"))
    both = rows.unionByName(again).select("movie", "day")
    bronze, silver = fresh_dir(spark, "bronze-dates"), fresh_dir(spark, "silver-dates")
    (both.select(F.lit(DATASOURCE).alias("datasource"), F.lit(INGEST_TS).cast("timestamp").alias("ingesttime"),
                 "movie", F.lit("new").alias("status"), F.col("day").alias("p_ingestdate"))
     .select(*BRONZE_WRITE_ORDER).write.partitionBy("p_ingestdate").parquet(bronze))
    bronze_to_silver(spark, bronze, silver)
    repair_quarantined(spark, bronze, silver)
    return _with_id(spark.read.parquet(bronze)).select("Id", "p_ingestdate", "status")


def q_merge_delete_escaped(spark, sf):
    """J3 where the emptied partitions are NULL and one whose name Spark escapes."""
    path, seg = fresh_dir(spark, "escaped"), F.col("c_mktsegment")
    c = table(spark, sf, "customer").select("c_custkey", F.when(seg == "BUILDING", "a:b=%/c").when(
        seg == "MACHINERY", F.lit(None)).otherwise(seg).alias("p"))
    c.write.partitionBy("p").parquet(path)
    doomed = c.where(F.col("p").isNull() | (F.col("p") == "a:b=%/c") | (F.col("c_custkey") % 3 == 0))
    merge_delete_path(spark, path, doomed.select("c_custkey"), "c_custkey", partition_by=("p",))
    return spark.read.parquet(path).select("c_custkey")


def q_land_drain_full(spark, sf):
    """C4 until the backlog is empty: many rows share name and time, some have none."""
    landing, raw_dir = fresh_dir(spark, "landing"), fresh_dir(spark, "landed")
    a = activity_records(spark, sf)
    shared = a.select("event_id", F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 5).cast("string")).alias("name"),
                      F.when(F.col("event_id") % 11 != 0, F.col("time") - F.col("time") % 86400).alias("time"))
    prepare_activity_path(spark, shared, landing, tz="UTC", tie_breaker="event_id")
    batches = []
    while landed := land_next_batches(spark, landing, raw_dir, hours=300, tie_breaker="event_id", first=len(batches) + 1):
        batches += landed
    schema = f"event_id {a.schema['event_id'].dataType.simpleString()}, batch INT"
    return spark.read.schema(schema).json(raw_dir) if batches else spark.createDataFrame([], schema)


def q_raw_inventory(spark, sf):
    """The listed files, joined with the records that each holds."""
    path = _envelope(spark, sf)
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    inv = raw_inventory(spark, path, "*.txt").where("length > 0").select(name("path").alias("file"))
    held = spark.read.text(path).groupBy(name("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return inv.join(held, "file").agg(F.sum("n").alias("records"))


def q_merge_hot_key(spark, sf):
    """C2 on a Bronze where every 1-URGENT order carries one identical record text.

    A fifth of all rows share one merge key: the merge source collapses them
    map-side, and the target side probes a broadcast (or, past the size
    bound, a sort-merge join whose skewed partition AQE splits).
    """
    o = table(spark, sf, "orders")
    hot = F.col("o_orderpriority") == "1-URGENT"
    text = F.when(hot, F.lit('{"Id":-1,"RunTime":5,"Budget":2000000.0}')).otherwise(
        F.to_json(F.struct(F.col("o_orderkey").alias("Id"), F.lit(100).alias("RunTime"),
                           (F.col("o_totalprice") * 10).alias("Budget"))))
    bronze = fresh_dir(spark, "bronze-hot")
    ingest_metadata(o.select(text.alias("movie")), DATASOURCE, INGEST_TS).select(
        *BRONZE_WRITE_ORDER).write.partitionBy("p_ingestdate").parquet(bronze)
    bronze_to_silver(spark, bronze, fresh_dir(spark, "silver-hot"))
    b = _with_id(spark.read.parquet(bronze))
    return b.groupBy((F.col("Id") == -1).alias("hot"), "status").agg(F.count(F.lit(1)).alias("n"))


def q_split_nulls_quarantine(spark, sf):
    """F4 with ``nulls="quarantine"``: rows that meet neither predicate go to quarantine."""
    c = classify(_parsed(spark, sf), nulls="quarantine")
    return c.groupBy(OUTCOME).agg(F.count(F.lit(1)).alias("n"))


def q_raw_peek(spark, sf):
    """The first lines of the raw files (the limit is the feature: a peek)."""
    return peek_raw(spark, _envelope(spark, sf), 3).select(
        F.col("value").like('{"movie":[{%}]}').alias("envelope"))


def q_split_outcome(spark, sf):
    return classify(_parsed(spark, sf)).groupBy(OUTCOME).agg(F.count(F.lit(1)).alias("n"))


_QUERIES: dict[str, Query] = {
    "json_envelope_read": q_json_envelope_read,
    "json_envelope_read_lines": q_json_envelope_read_lines,
    "json_permissive": q_json_permissive,
    "json_corrupt": q_json_corrupt,
    "ingest_metadata": q_ingest_metadata,
    "bronze_write_read": q_bronze_write_read,
    "silver_project": q_silver_project,
    "split_clean": _split_part(0),
    "split_quarantine": _split_part(1),
    "split_unclassified": _split_part(2),
    "split_outcome": q_split_outcome,
    "split_nulls_quarantine": q_split_nulls_quarantine,
    "null_profile": q_null_profile,
    "merge_status": q_merge_status,
    "merge_status_digest": q_merge_status_digest,
    "merge_dup_source": q_merge_dup_source,
    "merge_hot_key": q_merge_hot_key,
    "merge_delete": q_merge_delete,
    "prepare_activity": q_prepare_activity,
    "land_next_batch": q_land_next_batch,
    "land_drain": q_land_drain,
    "repair_abs": q_repair_abs,
    "repair_lookup": q_repair_lookup,
    "genre_lookup": q_genre_lookup,
    "genre_junction": q_genre_junction,
    "genre_append_new": q_genre_append_new,
    "genre_table": q_genre_table,
    "languages": q_languages,
    "languages_distinct": q_languages_distinct,
    "dedupe_all": q_dedupe_all,
    "dedupe_rows": q_dedupe_rows,
    "medallion_e2e": q_medallion_e2e,
    "stream_bronze": q_stream_bronze,
    "stream_progress": q_stream_progress,
    "stream_to_silver": q_stream_to_silver,
    "raw_rejects": q_raw_rejects,
    "raw_one_document": q_raw_one_document,
    "raw_one_document_files": q_raw_one_document_files,
    "stream_one_document": q_stream_one_document,
    "silver_repeatable": q_silver_repeatable,
    "land_cursor_drain": q_land_cursor_drain,
    "land_half": q_land_half,
    "stream_medallion": q_stream_medallion,
    "repair_catalog_lookup": q_repair_catalog_lookup,
    "activity_session_zone": q_activity_session_zone,
    "ingest_clock": q_ingest_clock,
    "catalog_database": q_catalog_database,
    "merge_few_keys": q_merge_few_keys,
    "merge_multi_date": q_merge_multi_date,
    "merge_delete_escaped": q_merge_delete_escaped,
    "land_drain_full": q_land_drain_full,
    "raw_inventory": q_raw_inventory,
    "raw_peek": q_raw_peek,
}


# --- DuckDB oracles -----------------------------------------------------------

M = """WITH m AS (
  SELECT o_orderkey AS Id, c_name AS Title, o_totalprice * 10 AS Budget,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE CAST(trunc(c_acctbal) AS BIGINT) END AS RunTime,
         c_mktsegment AS OriginalLanguage,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ReleaseDate,
         n_nationkey, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey
              JOIN nation ON c_nationkey = n_nationkey),
mc AS (
  SELECT *, CASE WHEN RunTime > 0 AND Budget >= 1000000 THEN 'loaded'
                 WHEN RunTime <= 0 OR Budget < 1000000 THEN 'quarantined'
                 ELSE 'new' END AS outcome
  FROM m)
"""

ACT = """WITH a AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS name,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS time_s,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
         CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
         CAST(hour(ts) AS INTEGER) AS hour, event_type, ts
  FROM events),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY month, day, hour, event_id) AS rn FROM a)
"""

# the backlog of ``_shared_landing``: whole hours, some times missing
SHARED = ACT + """, shared AS (
  SELECT event_id, count(*) OVER () AS total,
         row_number() OVER (ORDER BY CASE WHEN event_id % 11 <> 0 THEN month END NULLS FIRST,
                            CASE WHEN event_id % 11 <> 0 THEN day END NULLS FIRST,
                            CASE WHEN event_id % 11 <> 0 THEN hour END NULLS FIRST, event_id) AS rn
  FROM a)
"""

_ORACLE = {
    "json_envelope_read": M + "SELECT Id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate FROM m",
    "json_envelope_read_lines": M + "SELECT Id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate FROM m",
    "json_permissive": """
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN o_orderkey END AS Id,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice * 10 END AS Budget,
  CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED') THEN o_custkey END AS RunTime
FROM orders""",
    "json_corrupt": """
SELECT o_orderkey, o_orderpriority IN ('2-HIGH', '3-MEDIUM', '5-LOW') AS corrupt FROM orders""",
    "ingest_metadata": M + f"SELECT Id, '{DATASOURCE}' AS datasource, 'new' AS status, "
                           f"DATE '{INGEST_DATE}' AS p_ingestdate FROM m",
    "bronze_write_read": M + f"SELECT 'new' AS status, DATE '{INGEST_DATE}' AS p_ingestdate, "
                             "count(*) AS n FROM m",
    "silver_project": M + "SELECT Id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate, "
                          f"'new' AS status, DATE '{INGEST_DATE}' AS p_ingestdate "
                          "FROM mc WHERE outcome = 'loaded'",
    "split_clean": M + "SELECT Id, Title, Budget, RunTime FROM m WHERE RunTime > 0 AND Budget >= 1000000",
    "split_quarantine": M + "SELECT Id, Title, Budget, RunTime FROM m WHERE RunTime <= 0 OR Budget < 1000000",
    "split_unclassified": M + "SELECT Id, Title, Budget, RunTime FROM m "
                              "WHERE (RunTime > 0 AND Budget >= 1000000) IS NOT TRUE "
                              "AND (RunTime <= 0 OR Budget < 1000000) IS NOT TRUE",
    "split_outcome": M + "SELECT outcome, count(*) AS n FROM mc GROUP BY outcome",
    "split_nulls_quarantine": M + """
SELECT CASE WHEN outcome = 'loaded' THEN 'loaded' ELSE 'quarantined' END AS outcome, count(*) AS n
FROM mc GROUP BY 1""",
    "null_profile": M + """
SELECT 'rows' AS metric, count(*) AS value FROM m
UNION ALL
SELECT 'complete', count(*) FILTER (WHERE Id IS NOT NULL AND Title IS NOT NULL AND Budget IS NOT NULL
  AND RunTime IS NOT NULL AND OriginalLanguage IS NOT NULL AND ReleaseDate IS NOT NULL) FROM m
UNION ALL
SELECT 'after_na_drop', count(*) FROM m WHERE Id IS NOT NULL AND Title IS NOT NULL
  AND Budget IS NOT NULL AND RunTime IS NOT NULL AND OriginalLanguage IS NOT NULL
  AND ReleaseDate IS NOT NULL""",
    "merge_status": M + "SELECT Id, outcome AS status FROM mc",
    "merge_status_digest": M + "SELECT Id, outcome AS status FROM mc",
    "merge_dup_source": M + "SELECT Id, outcome AS status FROM mc UNION ALL SELECT Id, outcome FROM mc",
    "merge_hot_key": """
SELECT o_orderpriority = '1-URGENT' AS hot,
       CASE WHEN o_orderpriority = '1-URGENT' OR o_totalprice * 10 >= 1000000 THEN 'loaded'
            ELSE 'quarantined' END AS status,
       count(*) AS n
FROM orders GROUP BY 1, 2""",
    "merge_delete": ACT + """
SELECT e.event_id FROM a e
WHERE NOT EXISTS (SELECT 1 FROM a k
                  WHERE (k.event_type = 'click' OR k.day = 1)
                    AND k.name = e.name AND k.time_s = e.time_s)""",
    "prepare_activity": ACT + "SELECT event_id, name, time, day, month, hour FROM a",
    "land_next_batch": ACT + "SELECT event_id, time, day, month, hour FROM ranked WHERE rn <= 100",
    "land_drain": ACT + "SELECT event_id, CAST(CASE WHEN rn <= 300 THEN (rn - 1) // 100 + 1 ELSE 0 END "
                        "AS INTEGER) AS batch FROM ranked",
    "repair_abs": M + "SELECT Id, abs(RunTime) AS RunTime FROM mc WHERE outcome = 'quarantined'",
    "repair_lookup": """
SELECT e.event_id, CAST(u.c_custkey AS INTEGER) AS device_id, CAST(e.user_id AS VARCHAR) AS name,
       CAST(e.ts AS DATE) AS p_eventdate
FROM events e JOIN customer u ON e.user_id = u.c_custkey""",
    "genre_lookup": M + "SELECT n_nationkey AS genre_id, max(n_name) AS genre_name FROM m GROUP BY 1",
    "genre_junction": M + "SELECT DISTINCT Id, n_nationkey AS genre_id FROM m",
    "genre_append_new": M + """
SELECT n_nationkey AS genre_id, max(n_name) AS genre_name FROM m
WHERE n_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)
GROUP BY 1""",
    "genre_table": M + "SELECT n_nationkey AS genre_id, max(n_name) AS genre_name FROM mc "
                       "WHERE outcome = 'quarantined' GROUP BY 1",
    "languages": M + "SELECT OriginalLanguage FROM mc WHERE outcome = 'quarantined'",
    "languages_distinct": M + "SELECT DISTINCT OriginalLanguage FROM mc WHERE outcome = 'quarantined'",
    "dedupe_all": M + "SELECT Id, Title, Budget, RunTime, OriginalLanguage, ReleaseDate FROM m",
    "dedupe_rows": M + "SELECT DISTINCT Id, Title, Budget, RunTime FROM m",
    "medallion_e2e": M + """
SELECT 'bronze' AS layer, CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END AS status,
       count(*) AS n FROM mc GROUP BY 2
UNION ALL
SELECT 'silver', CASE WHEN outcome = 'loaded' THEN 'new' ELSE 'quarantined' END, count(*)
FROM mc WHERE outcome <> 'new' GROUP BY 2""",
    "stream_bronze": M + f"SELECT Id, 'new' AS status, DATE '{INGEST_DATE}' AS p_ingestdate FROM m",
    "stream_progress": M + "SELECT CAST(count(*) AS BIGINT) AS envelopes, true AS over_100 FROM m",
    "stream_to_silver": M + f"""
SELECT Id, CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END AS status,
       CASE WHEN OriginalLanguage < 'FURNITURE' THEN DATE '{INGEST_DATE}' ELSE DATE '{LATER_DATE}' END AS p_ingestdate
FROM mc""",
    "raw_rejects": """
SELECT CASE WHEN o_orderpriority = '2-HIGH' THEN 'rejected' ELSE 'accepted' END AS kind, count(*) AS n
FROM orders GROUP BY 1""",
    "raw_one_document": """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'trailing' WHEN '2-HIGH' THEN 'unparsed' WHEN '3-MEDIUM' THEN 'trailing'
            WHEN '4-NOT SPECIFIED' THEN 'unfit' ELSE 'accepted' END AS kind, count(*) AS n
FROM orders GROUP BY 1""",
    "raw_one_document_files": """
SELECT CASE n_regionkey WHEN 0 THEN 'trailing' WHEN 1 THEN 'trailing' WHEN 2 THEN 'unparsed' ELSE 'accepted' END AS kind,
       count(*) AS n
FROM nation GROUP BY 1""",
    "stream_one_document": f"""
SELECT o_orderkey AS Id, 'new' AS status, DATE '{INGEST_DATE}' AS p_ingestdate
FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderpriority IS NULL""",
    "silver_repeatable": M + """
SELECT 'silver' AS layer, Id, CASE WHEN outcome = 'loaded' THEN 'new' ELSE 'quarantined' END AS status
FROM mc WHERE outcome <> 'new'
UNION ALL
SELECT 'bronze', Id, CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END FROM mc
UNION ALL
SELECT DISTINCT 'genre', CAST(n_nationkey AS BIGINT), '' FROM mc WHERE outcome = 'quarantined'""",
    "land_cursor_drain": SHARED + """
SELECT event_id, CAST((rn - 1) // (10 * CAST(ceil(total / 200.0) AS BIGINT)) + 1 AS INTEGER) AS batch FROM shared""",
    "land_half": SHARED + """
SELECT event_id, CAST(rn <= 10 * (total // 20) AS INTEGER) AS batch FROM shared""",
    "stream_medallion": M + """
SELECT 'bronze' AS layer, Id, CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END AS status FROM mc
UNION ALL
SELECT 'silver', Id, CASE WHEN outcome = 'loaded' THEN 'new' ELSE 'quarantined' END FROM mc WHERE outcome <> 'new'""",
    "repair_catalog_lookup": """
WITH e AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE user_id END AS device,
         CASE WHEN event_id % 3 = 0 THEN 'n/a' WHEN event_id % 11 <> 0 THEN event_id::VARCHAR END AS heart
  FROM events)
SELECT CASE WHEN c_custkey IS NULL THEN 'unmatched' WHEN heart = 'n/a' THEN 'rejected:heartrate' ELSE 'repaired' END AS kind,
       event_id, CASE WHEN heart IS DISTINCT FROM 'n/a' THEN c_custkey::INTEGER END AS device_id,
       CASE WHEN c_custkey IS NOT NULL THEN TRY_CAST(heart AS INTEGER) END AS heartrate
FROM e LEFT JOIN customer ON c_custkey = device AND c_custkey % 4 <> 0""",
    # New York's clock changes of 2024: 10 March 07:00 UTC, 3 November 06:00 UTC
    "activity_session_zone": """
SELECT event_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS time, day(w)::INTEGER AS day, month(w)::INTEGER AS month,
       hour(w)::INTEGER AS hour
FROM (SELECT event_id, epoch_ms(1000 * (t - CASE WHEN t >= 1710054000 AND t < 1730613600 THEN 14400 ELSE 18000 END)) AS w
      FROM (SELECT event_id, 1704067200 + (event_id * 7919 * 61) % 31536000 AS t FROM events))""",
    "ingest_clock": M + "SELECT count(*) AS n, true AS one_instant, true AS same_date FROM m",
    "catalog_database": M + f""", d AS (
  SELECT *, CASE WHEN Id % 2 = 0 THEN '{INGEST_DATE}' ELSE '{LATER_DATE}' END AS part FROM mc)
SELECT 'bronze_movie' AS name, part, count(*) AS n FROM d GROUP BY part
UNION ALL
SELECT 'silver_movie', part, count(*) FROM d WHERE outcome <> 'new' GROUP BY part
UNION ALL
SELECT 'genre', n_nationkey::VARCHAR, 1 FROM d WHERE outcome = 'quarantined' GROUP BY n_nationkey""",
    "merge_few_keys": M + f"""
SELECT Id, CASE WHEN Id % 2000 = 1 THEN 'loaded' ELSE 'new' END AS status,
       CASE WHEN Id % 2 = 0 THEN DATE '{INGEST_DATE}' ELSE DATE '{LATER_DATE}' END AS p_ingestdate FROM m""",
    "merge_multi_date": M + f"""
SELECT Id, CASE WHEN Id % 50 <> 0 THEN CAST(date_trunc('month', CAST(ReleaseDate AS DATE)) AS DATE) END AS p_ingestdate,
       CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END AS status FROM mc
UNION ALL
SELECT Id, DATE '{LATER_DATE}', CASE WHEN outcome = 'new' THEN 'new' ELSE 'loaded' END FROM mc WHERE Id % 4 = 0""",
    "merge_delete_escaped": """
SELECT c_custkey FROM customer
WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AND c_custkey % 3 <> 0""",
    "land_drain_full": ACT + """
SELECT event_id, CAST((row_number() OVER (
         ORDER BY CASE WHEN event_id % 11 <> 0 THEN month END NULLS FIRST,
                  CASE WHEN event_id % 11 <> 0 THEN day END NULLS FIRST, event_id) - 1) // 3000 + 1 AS INTEGER) AS batch
FROM a""",
    "raw_inventory": M + "SELECT CAST(count(*) AS BIGINT) AS records FROM m",
    "raw_peek": "SELECT true AS envelope FROM range(3)",
}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


__all__ = ["queries", "oracle_sql"]
