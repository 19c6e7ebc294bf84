"""Mix sources to target weights by fitting subset sums of document lengths.

Method. Documents are counted by (source, exact length). A source whose target
is at least its size is taken whole as often as it fits; the rest of its budget
is shared out over the lengths in proportion, and the last ``EXACT_WORDS`` or
fewer are filled by a bounded-knapsack program over the unused documents. Of
each length the chosen number of documents is then taken in seeded order.

Only counts by length reach a task of one source (their number is at most the
longest document, and at most the square root of twice the source's words). The
documents are chosen by count: whole hash ranges are taken, and only the range
on the border is ordered.

Defined cases: a null text has length 0; documents of length 0 are never taken;
null is a source of its own, ordered last; repeated rows are documents of their
own, and among rows equal in id and text any may be taken; an empty table gives
an empty result; further columns are never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import FILE, KEYS, ROW, keyed, scanned, staged, word_count

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
SEED = 17
EXACT_WORDS = 4096
#: Documents in a hash range of one (source, length).
RANGE_DOCS = 1000


def _shares(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """About ``budget / size`` of the documents of each length, at most ``budget`` words.

    From the longest down; what rounding leaves over or takes too much is made
    good by the next length.
    """
    size, take = int((lengths * counts).sum()), np.zeros(len(lengths), dtype=np.int64)
    due, left = 0.0, budget
    for i in range(len(lengths) - 1, -1, -1):
        step, most = int(lengths[i]), int(counts[i])
        due += step * most * budget / size
        n = max(0, min(most, round(due / step), left // step))
        take[i], due, left = n, due - n * step, left - n * step
    return take


def _fill(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: the counts with the largest sum up to ``budget`` (exact)."""
    take = np.zeros(len(lengths), dtype=np.int64)
    # used[s]: documents of length first[s] in the sum s, which that length reached first
    first, used = np.zeros(budget + 1, dtype=np.int64), np.zeros(budget + 1, dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    for i in range(len(lengths)):
        step, most = int(lengths[i]), int(counts[i])
        if step > budget or reached[budget]:
            break
        if not most:
            continue
        # along each residue of the length: steps since a sum reached without it
        n = -(-(budget + 1) // step)
        grid = np.zeros(n * step, dtype=bool)
        grid[: budget + 1] = reached
        at = np.arange(n)[:, None]
        last = np.maximum.accumulate(np.where(grid.reshape(n, step), at, -1), axis=0)
        steps = np.where(last < 0, most + 1, at - last).ravel()[: budget + 1]
        new = ~reached & (steps <= most)
        first[new], used[new] = i, steps[new]
        reached |= new
    at = int(np.flatnonzero(reached).max())
    while at > 0:
        i, n = int(first[at]), int(used[at])
        take[i] += n
        at -= n * int(lengths[i])
    return take


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int,
               exact: int = EXACT_WORDS) -> np.ndarray:
    """How many documents of each length (ascending, distinct, > 0) to take for ``budget`` words.

    The sum never exceeds the budget. All but a remainder is shared out over
    the lengths; the program fills the remainder from the unused documents. Of
    a wide, a middle and a narrow remainder the one that comes nearest counts
    (a budget up to ``exact`` is a remainder as a whole, so its fit is the best
    there is).
    """
    if budget >= int((lengths * counts).sum()):
        return counts.copy()
    best = np.zeros(len(lengths), dtype=np.int64)
    for margin in (exact, exact // 8, 0):
        take = _shares(lengths, counts, max(0, budget - margin))
        left = budget - int((lengths * take).sum())
        if left > exact:  # the longest unused documents that fit
            for i in range(len(lengths) - 1, -1, -1):
                more = min(int(counts[i] - take[i]), max(0, left - exact // 2) // int(lengths[i]))
                take[i], left = take[i] + more, left - more * int(lengths[i])
        take = take + _fill(lengths, counts - take, min(left, exact))
        if int((lengths * take).sum()) > int((lengths * best).sum()):
            best = take
        if int((lengths * best).sum()) == budget:
            break
    return best


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most_times: int = MOST_TIMES) -> DataFrame:
    """``source, source_size, target``: weight shares of all words, with full sources cut.

    ``sizes`` has a row for each source (``source, source_size``). Sources in
    code point order, null last, take the weights in turn. A target stops at
    ``most_times`` the source's size; the excess is shared by weight among the
    others, until none is above. This is the level L with
    sum(min(cap, weight * L)) = all words, read off the sources in order of
    cap / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    table = (sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1))
             .withColumn("cap", F.lit(float(most_times)) * F.col("source_size")))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = (table.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("level", (F.sum("source_size").over(every) - F.col("full")) / F.col("open")))
    # the first source that stays under its cap gives the level; later ones give less
    under = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    table = table.withColumn("level", F.coalesce(F.max(under).over(every), F.lit(float("inf"))))
    return table.select("source", "source_size",
                        F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    target, size = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
    budget = round(target)
    whole = budget // size if size else 0
    take = fit_budget(group["size"].to_numpy(), group["docs"].to_numpy(), budget - whole * size) if size else 0
    return group.assign(whole=whole, take=take)[["source", "size", "docs", "source_size", "target", "whole", "take"]]


def _order(seed: int, doc_id: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def mix(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES,
        seed: int = SEED, scan: bool = False) -> DataFrame:
    """A row for each document, keyed by row: ``doc_id, source, size, source_size, target, copies``."""
    body = F.col(f"`{text}`").cast("string")
    rows = staged(spark, keyed(
        spark, docs, F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        word_count(body).alias("size"), _order(seed, F.col(f"`{doc_id}`"), body).alias("order"),
        scan=scan), "mix-rows")
    lengths = staged(spark, rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-lengths")
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = staged(spark, source_targets(sizes, weights, most_times), "mix-targets")
    plan = (lengths.where("size > 0").join(targets, lengths["source"].eqNullSafe(targets["source"]))
            .select(lengths["source"], "size", "docs", "source_size", "target"))
    plan = staged(spark, plan.groupBy("source").applyInPandas(
        _fit, "source string, size long, docs long, source_size long, target double, whole long, take long"), "mix-plan")

    # the border of each (source, length): ranges below it are taken, the range on it is ordered
    key = F.xxhash64(F.col("source"), F.col("source").isNull(), F.col("size")).alias("key")
    plan = staged(spark, plan.select(key, "take", "whole", F.ceil(F.col("docs") / RANGE_DOCS).alias("ranges")), "mix-plan")
    ranged = rows.select(*KEYS, key, "order").join(plan.where("take > 0"), "key").select(
        *KEYS, "key", "order", "take", F.pmod("order", "ranges").alias("range"))
    ranged = staged(spark, ranged, "mix-ranges")
    counts = ranged.groupBy("key", "take", "range").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("key").orderBy("range"))
    edges = staged(spark, counts.withColumn("to", so_far).withColumn("from", F.col("to") - F.col("n"))
                   .where(F.col("from") < F.col("take"))
                   .select("key", "range", F.least("n", F.col("take") - F.col("from")).alias("need"), "n"), "mix-edges")
    whole = ranged.join(edges.where("need = n"), ["key", "range"], "left_semi").select(*KEYS)
    place = F.row_number().over(Window.partitionBy("key", "range").orderBy("order", *KEYS))
    part = (ranged.join(edges.where("need < n").select("key", "range", "need"), ["key", "range"])
            .withColumn("place", place).where("place <= need").select(*KEYS))
    chosen = staged(spark, whole.union(part).withColumn("one", F.lit(1)), "mix-chosen")

    sourced = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(
        F.bround("target") / F.col("source_size"))).otherwise(0))
    joined = rows.join(sourced, rows["source"].eqNullSafe(sourced["source"])).select(
        *KEYS, "doc_id", rows["source"], "size", "source_size", "target", "whole")
    return joined.join(chosen, list(KEYS), "left").select(
        *KEYS, "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce("one", F.lit(0))).otherwise(0)
        .cast("long").alias("copies"))


def take_mix(spark: SparkSession, docs: DataFrame, scan: bool = False, **options) -> DataFrame:
    """``docs`` as the mix takes them: each document as often as its ``copies``; same columns."""
    docs = scanned(spark, docs, scan)
    taken = staged(spark, mix(spark, docs, scan=True, **options).where("copies > 0")
                   .select(*KEYS, F.col("copies").alias("__llm_copies")), "mix-taken")
    full = keyed(spark, docs, *[F.col(f"`{c}`") for c in docs.columns], scan=True)
    # sort-merge at every size, as in ``without``
    return (full.join(taken.hint("merge"), list(KEYS))
            .withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
