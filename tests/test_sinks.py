import os

import pytest

from strata.session import fresh_dir
from strata.sinks.writers import batch_writer, overwrite, write_new
from strata.sources.raw import peek_raw, raw_inventory


def test_self_overwrite_is_refused(spark):
    path = fresh_dir(spark, "t-self")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError):
        overwrite(df, path)
    assert spark.read.parquet(path).count() == 10


def test_overwrite_elsewhere(spark):
    a, b = fresh_dir(spark, "t-a"), fresh_dir(spark, "t-b")
    spark.range(5).write.parquet(a)
    overwrite(spark.read.parquet(a), b)
    overwrite(spark.read.parquet(a).limit(2), b)
    assert spark.read.parquet(b).count() == 2


def test_write_new_fails_if_exists(spark):
    a = fresh_dir(spark, "t-new")
    write_new(spark.range(3), a)
    with pytest.raises(Exception):
        write_new(spark.range(3), a)


def test_batch_writer_drops_and_partitions(spark):
    a = fresh_dir(spark, "t-bw")
    df = spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2")], "id INT, movie STRING, p STRING")
    batch_writer(df, "p", exclude_columns=["movie", "absent"]).save(a)
    back = spark.read.parquet(a)
    assert sorted(back.columns) == ["id", "p"] and sorted(os.listdir(a))[:2] == ["._SUCCESS.crc", "_SUCCESS"]


def test_inventory_and_peek(spark):
    a = fresh_dir(spark, "t-inv")
    spark.createDataFrame([("l1",), ("l2",), ("l3",)], "value STRING").coalesce(1).write.text(a)
    inv = raw_inventory(spark, a, "*.txt").collect()
    assert len(inv) == 1 and inv[0].length > 0
    assert peek_raw(spark, a, 2).count() == 2
