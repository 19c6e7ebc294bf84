"""URL filters: captures judged against lists as they stood at fetch time.

Method: a temporal list join. The dated entries of a pattern become validity
intervals: an entry holds from its date until the next entry of the same
pattern; ``remove`` ends the listing. A capture's URL gives the patterns that
can match it (its host and parent domains, and its host with each leading part
of the path), and an as-of join finds the interval in which the fetch time
lies. The most specific listed pattern decides: ``block`` or ``allow``.

The join is an equality join on (pattern, slice of time): an interval is cut at
the slices, within the span of the captures, so a pattern with a long history
meets only the few entries of a slice, and each capture meets at most one
interval of a pattern. Hot hosts are spread over slices, and the planner may
split what is still hot.

Defined cases: a null URL, or one without a host, matches nothing; a null fetch
time matches nothing; entries with a null pattern, date or action are ignored;
entries of one pattern and date: ``remove`` is applied first, then ``allow``,
then ``block``; repeated captures are judged each; empty tables on either side
give captures without a match; further columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import KEYS, keyed, scanned, staged

#: Days of a time slice.
SLICE_DAYS = 30

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and last dot; null if there is none."""
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(".")), F.lit(""))


def url_patterns(url: Column) -> Column:
    """Patterns that can match the URL: ``a.b.c``, ``b.c``, ``c``, ``a.b.c/x/``, ``a.b.c/x/y``."""
    host = url_host(url)
    labels = F.split(host, r"\.", -1)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, PATH, 1)
    steps = F.split(path, "/", -1)
    heads = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.concat(
        host, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.when(i < F.size(steps), F.lit("/")).otherwise(F.lit(""))))
    heads = F.filter(heads, lambda x: F.instr(x, "/") > 0)
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, heads)))


def intervals(entries: DataFrame, pattern: str = "pattern", listed_at: str = "listed_at",
              action: str = "action") -> DataFrame:
    """``(pattern, action, valid_from, valid_to)``: when each listing holds (``valid_to`` open or null).

    Of entries of one pattern and date, the one applied last counts. The host of
    a pattern is compared in lower case, its path as it stands.
    """
    host = F.regexp_extract(F.col(f"`{pattern}`"), "^[^/]*", 0)
    own = F.concat(F.lower(host), F.substr(F.col(f"`{pattern}`"), F.length(host) + 1))
    rows = entries.select(own.alias("pattern"), F.col(f"`{listed_at}`").alias("valid_from"),
                          F.lower(F.col(f"`{action}`")).alias("action")).na.drop()
    order = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).otherwise(0)
    last = rows.groupBy("pattern", "valid_from").agg(F.max(order).alias("rank"))
    by_date = Window.partitionBy("pattern").orderBy("valid_from")
    return (last.withColumn("valid_to", F.lead("valid_from").over(by_date)).where("rank > 0")
            .select("pattern", F.when(F.col("rank") == 2, "block").otherwise("allow").alias("action"),
                    "valid_from", "valid_to"))


def filter_urls(spark: SparkSession, captures: DataFrame, entries: DataFrame, url: str = "url",
                fetched_at: str = "fetched_at", *keep: Column, slice_days: int = SLICE_DAYS,
                scan: bool = False) -> DataFrame:
    """``keep`` with ``blocked, pattern, action, valid_from, valid_to`` for each capture, keyed by row."""
    captures = scanned(spark, captures, scan)
    rows = keyed(spark, captures, *keep, F.col(f"`{url}`").cast("string").alias("__llm_url"),
                 F.col(f"`{fetched_at}`").alias("__llm_time"), scan=True)
    number = lambda c: F.floor(F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")) / slice_days)
    span = rows.agg(F.min(number(F.col("__llm_time"))).alias("lo"),
                    F.max(number(F.col("__llm_time"))).alias("hi")).collect()[0]
    lo, hi = (0, -1) if span.lo is None else (span.lo, span.hi)
    first = F.greatest(number(F.col("valid_from")), F.lit(lo))
    last = F.least(F.coalesce(number(F.col("valid_to")), F.lit(hi)), F.lit(hi))
    cut = staged(spark, staged(spark, intervals(entries), "intervals").withColumn("first", first)
                 .withColumn("last", last).where("first <= last")
                 .withColumn("slice", F.explode(F.sequence("first", "last"))).drop("first", "last"), "interval-slices")
    keys = rows.select(*KEYS, "__llm_time", number(F.col("__llm_time")).alias("slice"),
                       F.explode(url_patterns(F.col("__llm_url"))).alias("pattern"))
    held = keys.join(cut, ["pattern", "slice"]).where(
        (F.col("__llm_time") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("__llm_time") < F.col("valid_to"))))
    # longest pattern first; an interval that touches two slices matches in one
    best = held.groupBy(*KEYS).agg(F.max(F.struct(
        F.length("pattern").alias("n"), "pattern", "action", "valid_from", "valid_to")).alias("best"))
    names = [c for c in rows.columns if c not in (*KEYS, "__llm_url", "__llm_time")]
    return rows.select(*KEYS, *names).join(staged(spark, best, "matches"), list(KEYS), "left").select(
        *KEYS, *names, F.coalesce(F.col("best.action") == "block", F.lit(False)).alias("blocked"),
        *[F.col(f"best.{c}").alias(c) for c in ("pattern", "action", "valid_from", "valid_to")])
