import random

import pytest
from pyspark.sql import functions as F

from strata.operators import landing_cursor
from strata.operators.landing import prepare_activity_path
from strata.operators.landing_cursor import Landing, after_key, land_all, nth_value
from strata.session import fresh_dir
from strata.sinks.files import child_names, path_exists


def backlog(spark, rows):
    """Rows ``(event_id, epoch seconds or None)`` as a prepared backlog."""
    path = fresh_dir(spark, "t-backlog")
    df = spark.createDataFrame([(i, "n", t) for i, t in rows], "event_id long, name string, time long")
    prepare_activity_path(spark, df, path, tz="UTC", tie_breaker="event_id")
    return path


def days(rng, n, n_days=4):
    return [(i, None if rng.random() < 0.05 else 1_704_067_200 + rng.randrange(n_days * 86400) // 1800 * 1800)
            for i in rng.sample(range(10 * n), n)]


def ids(spark, folder):
    return [r.event_id for r in spark.read.schema("event_id long").json(folder).collect()]


def in_order(rows):
    """Event ids by (month, day, hour), NULLs first, then id."""
    hour = lambda t: (0, 0) if t is None else (1, t // 3600)
    return [i for i, t in sorted(rows, key=lambda r: (hour(r[1]), r[0]))]


@pytest.mark.parametrize("hours", [1, 3, 7, 100])
def test_batches_are_the_order_cut_in_pieces(spark, hours):
    rows = days(random.Random(hours), 170)
    path, raw = backlog(spark, rows), fresh_dir(spark, "t-raw")
    batches = land_all(spark, path, raw, hours=hours, tie_breaker="event_id")
    want, n = in_order(rows), 10 * hours
    assert [sorted(ids(spark, b)) for b in batches] == [sorted(want[i:i + n]) for i in range(0, len(want), n)]
    assert land_all(spark, path, raw, hours=hours, tie_breaker="event_id") == []


def test_no_row_is_rewritten(spark):
    """The files of a partition stay as they are until it is passed, then they go."""
    rows = days(random.Random(2), 120, n_days=2)
    path, raw = backlog(spark, [r for r in rows if r[1]]), fresh_dir(spark, "t-raw")
    landing, seen = Landing(spark, path, "event_id"), []
    while True:
        seen.append(sorted(spark.read.parquet(path).inputFiles()) if landing.remaining() is not None else [])
        if landing.land(raw, hours=2) is None:
            break
    assert len(seen) > 4 and all(set(b) <= set(a) for a, b in zip(seen, seen[1:]))
    assert seen[0] == seen[1] and seen[-1] == []
    assert len([c for c in child_names(spark, f"{path}/_cursor") if c.startswith("batch-")]) == 1


def test_a_run_that_dies_lands_the_same_batch_again(spark, monkeypatch):
    rows = days(random.Random(3), 90)
    path, raw = backlog(spark, rows), fresh_dir(spark, "t-raw")

    def dies(*_):
        raise RuntimeError("lost")

    out = []
    for i in range(40):
        landing = Landing(spark, path, "event_id")  # a new process each time
        broken = ("_move", "_drop", None)[i % 3]
        with monkeypatch.context() as m:
            if broken:
                m.setattr(Landing, broken, dies)
            try:
                done = landing.land(raw, hours=2)
            except RuntimeError:
                continue
        if done is None:
            break
    batches = sorted(child_names(spark, raw))
    want = in_order(rows)
    for i, b in enumerate(batches):
        assert sorted(ids(spark, f"{raw}/{b}")) == sorted(want[20 * i:20 * i + 20])
        out += ids(spark, f"{raw}/{b}")
    assert sorted(out) == sorted(want)


def test_remaining_rows(spark):
    rows = days(random.Random(4), 60)
    path = backlog(spark, rows)
    landing = Landing(spark, path, "event_id")
    landing.land(fresh_dir(spark, "t-raw"), hours=4)
    again = Landing(spark, path, "event_id")
    assert sorted(r.event_id for r in again.remaining().collect()) == sorted(in_order(rows)[40:])


def test_half_is_written_by_many_tasks(spark):
    rows = [(i, 1_704_067_200 + 40 * i) for i in range(40_000)]
    path, raw = backlog(spark, rows), fresh_dir(spark, "t-raw")
    landing = Landing(spark, path, "event_id")
    out = landing.land(raw, hours=2000)
    span = landing._span(landing._rows(), landing.partitions(), landing_cursor.Cursor(0, 0, 0, None), landing.cursor())
    plan = span._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan
    assert sum(c.startswith("part-") for c in child_names(spark, out)) > 1
    assert sorted(ids(spark, out)) == list(range(20_000))


@pytest.mark.parametrize("top", [0, 50, 10_000])
def test_nth_value(spark, monkeypatch, top):
    monkeypatch.setattr(landing_cursor, "TOP", top)
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "c"]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "t string, i int").repartition(5)
    want = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), r[1]))
    for n in (1, 49, 50, 51, 299, 300):
        assert nth_value(spark, df, ["t", "i"], n) == want[n - 1]


def test_after_key_is_null_safe(spark):
    rows = [(a, b) for a in (None, 1, 2) for b in (None, 1, 2)]
    df = spark.createDataFrame(rows, "a int, b int")
    for i, key in enumerate(rows):  # the rows are in order
        got = sorted(map(repr, df.where(after_key(["a", "b"], key)).collect()))
        assert got == sorted(repr(r) for r in df.collect()[i + 1:])


def test_refuses_what_it_cannot_order(spark):
    with pytest.raises(ValueError):
        Landing(spark, "/nowhere", ())
    with pytest.raises(ValueError):
        Landing(spark, "/nowhere", "id", partition_by=("day",))


def test_empty_backlog(spark):
    path = backlog(spark, [])
    assert land_all(spark, path, fresh_dir(spark, "t-raw"), tie_breaker="event_id") == []
    assert not path_exists(spark, f"{path}/_cursor/batch-000000001")
