from pyspark.sql import functions as F

from strata.operators.repair import repair_typed

Q = [(1, "10", "60"), (2, "10", "x"), (3, "bad", "70"), (4, None, "70"), (5, "20", None), (6, "30", "80")]
U = [("10", "7"), ("20", "seven"), ("30", "1"), ("30", "2")]


def run(spark, q=Q, u=U):
    return repair_typed(
        spark, spark.createDataFrame(q, "id int, device string, rate string"),
        spark.createDataFrame(u, "user_id string, number string"), "device", "user_id",
        {"id": (F.col("q.id"), "int"), "number": (F.col("u.number"), "int"), "rate": (F.col("q.rate"), "int")})


def test_every_row_is_repaired_rejected_or_unmatched(spark):
    done = run(spark)
    assert sorted(map(tuple, done.repaired.collect())) == [(1, 7, 60), (6, 1, 80), (6, 2, 80)]
    told = {r.q.id: (r.reasons, r.given.number, r.given.rate) for r in done.rejected.collect()}
    assert told == {2: (["rate"], "7", "x"), 5: (["number"], "seven", None)}
    assert sorted(map(tuple, done.unmatched.collect())) == [(3, "bad", "70"), (4, None, "70")]
    assert done.counts == {"repaired": 3, "rejected": 2, "unmatched": 2}


def test_types_differ_and_tables_are_empty(spark):
    q = spark.createDataFrame([(1, "10"), (2, "ten")], "id int, device string")
    u = spark.createDataFrame([(10,)], "user_id int")
    done = repair_typed(spark, q, u, "device", "user_id", {"id": (F.col("q.id"), "int")})
    assert done.counts == {"repaired": 1, "rejected": 0, "unmatched": 1}
    assert run(spark, u=[]).counts == {"repaired": 0, "rejected": 0, "unmatched": len(Q)}
    assert run(spark, q=[]).counts == {"repaired": 0, "rejected": 0, "unmatched": 0}
