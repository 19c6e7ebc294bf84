import datetime as dt
import random
import re

from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.llm.url_filter import filter_urls, intervals, url_patterns

DAY = dt.datetime(2024, 1, 1)


def brute_patterns(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
    if not m or not m[1].lower().rstrip("."):
        return set()
    host = m[1].lower().rstrip(".")
    path = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", url)[1]
    labels, steps = host.split("."), path.split("/")
    out = {".".join(labels[i:]) for i in range(len(labels))}
    for i in range(1, len(steps) + 1):
        out.add(host + "/".join(steps[:i]) + ("/" if i < len(steps) else ""))
    return {x for x in out if "/" in x} | {".".join(labels[i:]) for i in range(len(labels))}


URLS = ["http://a.example.com/x/y.html?q=/z#f", "https://user@b.example.com:80/", "http://example.com", "ftp://EXAMPLE.com./x/",
        "http://", "no url", "", None, "http://a.example.com/x/" + "long/" * 500, "http://c.test/x//y"]


def test_patterns(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string").withColumn("p", url_patterns(F.col("u")))
    for r in df.collect():
        assert set(r.p or ()) == brute_patterns(r.u), r.u


def brute(url, when, entries):
    """Most specific pattern whose last entry up to the fetch time is a listing."""
    order = {"remove": 0, "allow": 1, "block": 2}
    best = None
    for p in brute_patterns(url) if when is not None else ():
        past = [(t, order[a], a) for q, t, a in entries if q and q.lower() == p and t and a and t <= when]
        if past and max(past)[2] != "remove":
            best = max(best or (0, "", ""), (len(p), p, max(past)[2]))
    return (best[1], best[2]) if best else (None, None)


def test_as_of_against_brute_force(spark):
    rng = random.Random(3)
    patterns = ["a.example.com", "example.com", "com", "a.example.com/x/", "a.example.com/x/y.html", "c.test", "Example.COM", "c.test/x//", None]
    entries = [(rng.choice(patterns), rng.choice([DAY + dt.timedelta(hours=rng.randrange(24 * 400)), None] + [DAY] * 2),
                rng.choice(["block", "allow", "remove", None])) for _ in range(150)]
    captures = [(i, rng.choice(URLS), rng.choice([None, *[DAY + dt.timedelta(hours=rng.randrange(-100, 24 * 500)) for _ in range(9)]]))
                for i in range(600)]
    captures += [(1000, "http://a.example.com/x/", DAY)] * 50
    left = staged(spark, spark.createDataFrame([(*c, "x", "y") for c in captures], "page_id long, url string, fetched_at timestamp, slice string, pattern string").repartition(4), "captures")
    right = spark.createDataFrame(entries, "pattern string, listed_at timestamp, action string")
    for days in (30, 1, 1000):
        got = filter_urls(spark, left, right, "url", "fetched_at", F.col("page_id"), slice_days=days).collect()
        assert len(got) == len(captures)
        found = {r.page_id: (r.pattern, r.action) for r in got}
        for i, url, when in captures:
            assert found[i] == brute(url, when, entries), (i, url, when)
        assert all(r.blocked == (r.action == "block") for r in got)


def test_intervals_do_not_overlap(spark):
    entries = spark.createDataFrame([("a", DAY, "block"), ("a", DAY + dt.timedelta(5), "remove"), ("a", DAY + dt.timedelta(9), "allow")],
                                    "pattern string, listed_at timestamp, action string")
    got = sorted((r.action, r.valid_from, r.valid_to) for r in intervals(entries).collect())
    assert got == [("allow", DAY + dt.timedelta(9), None), ("block", DAY, DAY + dt.timedelta(5))]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "pattern string, listed_at timestamp, action string")
    one = spark.createDataFrame([(1, "http://a/", DAY)], "page_id long, url string, fetched_at timestamp")
    assert [r.blocked for r in filter_urls(spark, one, none, "url", "fetched_at").collect()] == [False]
    some = spark.createDataFrame([("a", DAY, "block")], none.schema)
    assert filter_urls(spark, one.limit(0), some, "url", "fetched_at").count() == 0
    assert filter_urls(spark, one.withColumn("fetched_at", F.lit(None).cast("timestamp")), some, "url", "fetched_at").count() == 1


def test_case_of_the_path_counts(spark):
    entries = spark.createDataFrame([("A.Test/Blog/", DAY, "block"), ("B.TEST", DAY, "block")],
                                    "pattern string, listed_at timestamp, action string")
    urls = ["http://a.test/Blog/x", "http://a.test/blog/x", "http://A.TEST/Blog/", "http://b.Test/Y"]
    left = staged(spark, spark.createDataFrame([(u, DAY) for u in urls], "url string, fetched_at timestamp"), "captures")
    got = filter_urls(spark, left, entries, "url", "fetched_at", F.col("url")).collect()
    assert {r.url: r.pattern for r in got} == dict(zip(urls, ["a.test/Blog/", None, "a.test/Blog/", "b.test"], strict=True))
