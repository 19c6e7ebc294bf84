import os

from strata.session import fresh_dir
import pytest

from strata.sources.raw import raw_rejects, read_raw


def _files(spark, docs):
    d = fresh_dir(spark, "t-rawedge")
    os.makedirs(d)
    for name, text in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    return d


def test_multiline_reader_edges(spark):
    d = _files(spark, {
        "missing.txt": '{"other": [1]}',
        "empty.txt": '{"movie": []}',
        "null.txt": '{"movie": null}',
        "malformed.txt": '{"movie": [{"Id": 1}, ',
        "pretty.txt": '{\n  "movie": [\n    {"Id": 7,\n     "Title": "x y"},\n    {"Id": 8}\n  ]\n}\n',
        "two_docs.txt": '{"movie": [{"Id": 9}]}\n{"movie": [{"Id": 10}]}\n',
    })
    # a file that does not hold exactly one document is told, never read in part
    bad = {r.path.rsplit("/", 1)[-1] for r in raw_rejects(spark, d, multiline=True).collect()}
    assert bad == {"malformed.txt", "two_docs.txt"}
    with pytest.raises(ValueError):
        read_raw(spark, d, multiline=True)
    got = sorted(r.movie for r in read_raw(spark, d, multiline=True, rejects="skip").collect())
    # whitespace of the source text is kept
    assert got == ['{"Id": 7,\n     "Title": "x y"}', '{"Id": 8}']


def test_json_lines_reader_edges(spark):
    d = _files(spark, {
        "a.txt": '{"movie": [{"Id": 1,  "T": "a"}, {"Id": 2}]}\n{"movie": []}\n{"other": 1}\n{bad\n',
        "b.txt": '{"movie": [{"Id": 3}]}\n',
    })
    got = sorted(r.movie for r in read_raw(spark, d, rejects="skip").collect())
    assert got == ['{"Id": 1,  "T": "a"}', '{"Id": 2}', '{"Id": 3}']
    assert [r.document for r in raw_rejects(spark, d).collect()] == ["{bad"]
    with pytest.raises(Exception, match="does not parse"):
        read_raw(spark, d).collect()


# line: accepted records, or the reason
LINES = [
    ('{"movie": [{"Id": 1,  "T": "a\\u00e9"}, {"Id": 2}]}', ['{"Id": 1,  "T": "a\\u00e9"}', '{"Id": 2}']),
    ('{"movie":["A"]}{"movie":["B"]}', "trailing"),
    ('{"movie":[1]} trailing', "trailing"),
    ('{"movie":[1]},{"movie":[2]}', "trailing"),
    ('{"movie":[1]}][1', "trailing"),
    ('{"movie":[1]}]],[[2', "trailing"),
    ('{"movie":[1]},0]', "trailing"),
    ('{"movie":[1]},"x":{"movie":[2]}', "trailing"),
    ('{"movie":[1]},"end":0}', "trailing"),
    ('[{"movie":[{"a":  3}]},{"movie":[{"b":4}]}]', ['{"a":  3}', '{"b":4}']),
    ('[{"movie":[5]}] [2]', "unparsed"),
    ('[{"movie":[1]},{"movie":{"a":1}}]', "unfit"),
    ('[{"movie":[1]},null]', "unfit"),
    ('{"movie":[6],"movie":[7]}', ["7"]),
    ('  {"movie":["x  y"]}  ', ["x  y"]),
    ('', []), ('  \t', []), ('[]', []), ('{}', []), ('{"movie":null}', []),
    ('null', "unfit"), ('"str"', "unfit"), ('7', "unfit"), ('{"movie":{"a":1}}', "unfit"),
    ('{"movie":[{"a":1}}', "unparsed"), ('{bad', "unparsed"),
    ('{"movie":["\U0001f600", {"k":  "\u6f22"}]}', ['\U0001f600', '{"k":  "\u6f22"}']),
]


@pytest.mark.parametrize("one_file", [True, False])
def test_every_line_is_accepted_or_told(spark, one_file):
    lines = [x for x, _ in LINES]
    d = _files(spark, {"all.txt": "\n".join(lines)} if one_file else {f"f{i}.txt": x + "\n" for i, x in enumerate(lines)})
    told = sorted((r.document, r.reason) for r in raw_rejects(spark, d).collect())
    assert told == sorted((x, y) for x, y in LINES if isinstance(y, str))
    got = sorted(r.movie for r in read_raw(spark, d, rejects="skip").collect())
    assert got == sorted(m for _, y in LINES if not isinstance(y, str) for m in y)


def test_every_rejected_line_fails_by_default(spark):
    for line, want in LINES:
        d = _files(spark, {"f.txt": '{"movie":["ok"]}\n' + line + "\n"})
        if isinstance(want, str):
            with pytest.raises(Exception, match="raw document"):
                read_raw(spark, d).count()
        else:
            assert sorted(r.movie for r in read_raw(spark, d).collect()) == sorted(["ok", *want])


def test_stream_rejects_what_the_batch_reader_rejects(spark):
    from strata.session import unique_name
    from strata.streaming.bronze_stream import run_raw_to_bronze

    d = _files(spark, {f"f{i}.txt": "\n".join(x for x, _ in LINES[i::3]) for i in range(3)})
    bronze = fresh_dir(spark, "t-stream-bronze")
    with pytest.raises(Exception, match="raw document"):
        run_raw_to_bronze(spark, d, bronze, fresh_dir(spark, "t-ckpt"), unique_name("s"))
    run_raw_to_bronze(spark, d, bronze, fresh_dir(spark, "t-ckpt"), unique_name("s"), rejects="skip",
                      max_files_per_trigger=1)
    got = sorted(r.movie for r in spark.read.parquet(bronze).collect())
    assert got == sorted(m for _, y in LINES if not isinstance(y, str) for m in y)


def test_declared_encoding_normalizes_whitespace(spark):
    d = _files(spark, {"pretty.txt": '{\n  "movie": [\n    {"Id": 7,\n     "Title": "x y"}\n  ]\n}\n'})
    assert [r.movie for r in read_raw(spark, d, multiline=True, encoding="UTF-8").collect()] == ['{"Id":7,"Title":"x y"}']
