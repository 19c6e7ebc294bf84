from pyspark.sql import functions as F

from strata.session import fresh_dir, unique_name
from strata.sinks.catalog import register_table


def layer(spark, path, values):
    (spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, p string")
     .write.mode("append").partitionBy("p").parquet(path))


def test_a_registered_table_is_never_dropped(spark, monkeypatch):
    path, name = fresh_dir(spark, "t-cat"), unique_name("t")
    layer(spark, path, ["a", "b"])
    register_table(spark, name, path, partitions=[{"p": "a"}])  # new to the catalog: every folder counts
    assert spark.table(name).count() == 2
    said, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), plain(self, q, *a, **k))[1])
    layer(spark, path, ["b", "c", None, "it's", "x=y/z"])
    register_table(spark, name, path, partitions=[{"p": v} for v in ("b", "c", None, "it's", "x=y/z")])
    assert spark.table(name).count() == 7
    assert spark.table(name).where("p IS NULL").count() == 1
    layer(spark, path, ["d"])
    register_table(spark, name, path)  # without a report the folders are listed
    register_table(spark, name, path, partitions=())
    assert spark.table(name).count() == 8
    assert not any("DROP" in q or "CREATE" in q for q in said)


def test_a_table_at_another_place_is_replaced(spark):
    a, b, name = fresh_dir(spark, "t-a"), fresh_dir(spark, "t-b"), unique_name("t")
    layer(spark, a, ["a"])
    layer(spark, b, ["b", "c"])
    register_table(spark, name, a)
    register_table(spark, name, b)
    assert sorted(r.p for r in spark.table(name).collect()) == ["b", "c"]
    assert spark.read.parquet(a).count() == 1  # its files stay


def test_unpartitioned_table_shows_new_files(spark):
    path, name = fresh_dir(spark, "t-flat"), unique_name("t")
    for n in (1, 2):
        spark.range(1).select(F.col("id")).write.mode("append").parquet(path)
        register_table(spark, name, path, partitioned=False)
        assert spark.table(name).count() == n
