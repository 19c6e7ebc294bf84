import pytest
from pyspark.sql import functions as F

from strata.functions.activity import epoch_seconds_of_ntz
from strata.operators.landing import (
    land_next_batch,
    land_next_batches,
    next_batch,
    prepare_activity,
    prepare_activity_path,
)
from strata.session import fresh_dir
from strata.sources.driver_tables import activity_records

from conftest import SF0001


def test_time_parts_utc(spark):
    df = spark.createDataFrame([(1, 1704070807)], "event_id INT, time BIGINT")  # 2024-01-01 01:00:07Z
    r = prepare_activity(df, tz="UTC").collect()[0]
    assert (r.time, r.day, r.month, r.hour) == ("2024-01-01 01:00:07", 1, 1, 1)


def test_epoch_of_ntz_ignores_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 01:00:07.9' AS ts")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(epoch_seconds_of_ntz("ts")).collect()[0][0] == 1704070807
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_next_batch_total_order(spark):
    rows = [(i, "n", 0, 1, 1, 5) for i in range(30)]  # 30 rows share one hour
    df = spark.createDataFrame(rows, "event_id INT, name STRING, time INT, month INT, day INT, hour INT")
    got = [r.event_id for r in next_batch(df, hours=1, tie_breaker="event_id").collect()]
    assert sorted(got) == list(range(10))


def test_draining_returns_each_row_once(spark):
    landing = fresh_dir(spark, "t-landing")
    src = activity_records(spark, SF0001)
    n = src.count()
    prepare_activity_path(spark, src, landing, tz="UTC")
    raw = fresh_dir(spark, "t-landed")
    landed, sizes, bounds = [], [], []
    for i in range(n // 300 + 2):
        out = land_next_batch(spark, landing, raw, hours=30, tie_breaker="event_id",
                              batch_name=f"b{i}")
        if out is None:
            break
        rows = spark.read.json(out).select("month", "day", "hour", "event_id").collect()
        keys = sorted(tuple(r) for r in rows)
        bounds.append((keys[0], keys[-1]))
        sizes.append(len(rows))
        landed += [r.event_id for r in rows]
    # batches follow the total order: each one lies entirely after the previous
    assert all(prev[1] < nxt[0] for prev, nxt in zip(bounds, bounds[1:]))
    assert out is None  # drained
    assert sizes[:-1] == [300] * (len(sizes) - 1) and 0 < sizes[-1] <= 300
    assert sorted(landed) == sorted(r.event_id for r in src.select("event_id").collect())


def test_draining_shared_and_null_keys(spark):
    """Rows that share name and time, and rows without them, land once each."""
    rows = [(i, None if i % 4 == 0 else "n", None if i % 5 == 0 else 1704070807 + 86400 * (i % 3)) for i in range(70)]
    src = spark.createDataFrame(rows, "event_id INT, name STRING, time BIGINT")
    landing, raw, landed = fresh_dir(spark, "t-shared"), fresh_dir(spark, "t-shared-raw"), []
    prepare_activity_path(spark, src, landing, tz="UTC", tie_breaker="event_id")
    for i in range(20):
        out = land_next_batch(spark, landing, raw, hours=1, tie_breaker="event_id", batch_name=f"b{i}")
        if out is None:
            break
        batch = [r.event_id for r in spark.read.json(out).collect()]
        assert len(batch) == 10
        landed += batch
    assert out is None and sorted(landed) == list(range(70))


def test_a_tie_breaker_is_required(spark):
    with pytest.raises(ValueError):
        land_next_batch(spark, fresh_dir(spark, "t-none"), fresh_dir(spark, "t-none-raw"))


def test_a_hot_second_is_spread(spark):
    src = spark.range(20_000).selectExpr("id AS event_id", "'n' AS name", "1704070807 AS time")
    landing = fresh_dir(spark, "t-hot-second")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else 20,000 rows are one small partition
    spark.conf.set(key, "false")
    try:
        prepare_activity_path(spark, src, landing, tz="UTC", tie_breaker="event_id")
    finally:
        spark.conf.set(key, "true")
    files = spark.read.parquet(landing).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 15_000


def test_batches_landed_together_are_those_landed_in_turn(spark):
    """The same rows a batch, in one pass or two, by as many jobs however many batches there are."""
    rows = [(i, None if i % 4 == 0 else "n", None if i % 5 == 0 else 1704070807 + 86400 * (i % 3)) for i in range(75)]
    src = spark.createDataFrame(rows, "event_id INT, name STRING, time BIGINT")

    def backlog():
        path = fresh_dir(spark, "t-together")
        prepare_activity_path(spark, src, path, tz="UTC", tie_breaker="event_id")
        return path

    landing, raw, in_turn = backlog(), fresh_dir(spark, "t-in-turn"), []
    while (out := land_next_batch(spark, landing, raw, tie_breaker="event_id", batch_name=f"b{len(in_turn)}")) is not None:
        in_turn.append(sorted(r.event_id for r in spark.read.json(out).collect()))

    def together(most, rows_per_hour=10):
        landing, raw, folders = backlog(), fresh_dir(spark, "t-together-raw"), []
        while landed := land_next_batches(spark, landing, raw, tie_breaker="event_id", first=len(folders) + 1, most=most,
                                          rows_per_hour=rows_per_hour):
            assert most is None or len(landed) <= most
            folders += landed
        return [sorted(r.event_id for r in spark.read.json(f).collect()) for f in folders]

    assert together(None) == together(3) == in_turn and [len(b) for b in in_turn] == [10] * 7 + [5]

    def jobs(rows_per_hour):
        group = f"together-{rows_per_hour}"
        spark.sparkContext.setJobGroup(group, group)
        together_landing, raw = backlog(), fresh_dir(spark, "t-jobs")
        spark.sparkContext.setJobGroup(f"{group}-pass", group)
        land_next_batches(spark, together_landing, raw, tie_breaker="event_id", rows_per_hour=rows_per_hour)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{group}-pass"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    assert jobs(1) <= jobs(25) + 2  # 75 batches against 3; listing more folders may take a job of its own
