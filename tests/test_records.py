from strata.functions.records import parse_records, transform_bronze

TEXTS = [
    ("good", '{"Id": 1, "RunTime": 148, "Budget": 1.6E8, "genres": [{"id": 3, "name": "Drama"}]}'),
    ("malformed", "{bad"),
    ("null", None),
    ("wrong_type", '{"Id": "x", "RunTime": 5}'),
    ("wrong_case", '{"id": 9, "RunTime": 5}'),
    ("fraction", '{"Id": 2, "RunTime": 120.5, "Budget": 5000000}'),
    ("no_genres", '{"Id": 3}'),
    ("empty_genres", '{"Id": 4, "genres": []}'),
    ("empty_name", '{"Id": 5, "genres": [{"id": 1, "name": ""}]}'),
]


def _parsed(spark, **kw):
    df = spark.createDataFrame(TEXTS, "case STRING, movie STRING")
    return {r.case: r for r in parse_records(df, keep=("case",), **kw).collect()}


def test_permissive_outcomes(spark):
    p = _parsed(spark)
    assert (p["good"].Id, p["good"].RunTime, p["good"].Budget) == (1, 148, 1.6e8)
    assert p["good"].genres[0].name == "Drama"
    assert p["malformed"].Id is None and p["malformed"].RunTime is None
    assert p["null"].Id is None
    assert p["wrong_type"].Id is None and p["wrong_type"].RunTime == 5
    assert p["wrong_case"].Id is None and p["wrong_case"].RunTime == 5
    assert p["fraction"].Id == 2 and p["fraction"].RunTime is None
    assert p["no_genres"].genres is None
    assert p["empty_genres"].genres == []
    assert p["empty_name"].genres[0].name == ""


def test_corrupt_column_flags_bad_rows(spark):
    p = _parsed(spark, corrupt_column="_corrupt")
    assert p["malformed"]._corrupt == "{bad"
    assert p["good"]._corrupt is None


def test_transform_bronze_dedupes(spark):
    rows = [("{\"Id\": 1}", "new", None)] * 3 + [("{\"Id\": 2}", "new", None)]
    df = spark.createDataFrame(rows, "movie STRING, status STRING, p_ingestdate DATE")
    out = transform_bronze(df)
    assert out.count() == 2
    assert out.columns[0] == "movie" and out.columns[-2:] == ["status", "p_ingestdate"]
