"""Repair quarantined records."""

from __future__ import annotations

from collections.abc import Mapping

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_small
from strata.sinks.staging import stage_observed

#: Outcomes of a typed repair.
REPAIRED, REJECTED, UNMATCHED = "repaired", "rejected", "unmatched"


def repair_abs(df: DataFrame, column: str = "RunTime") -> DataFrame:
    """Replace a column by its absolute value (NULL stays NULL, 0 stays 0)."""
    return df.withColumn(column, F.abs(F.col(column)))


def repair_by_lookup(quarantined: DataFrame, lookup: DataFrame, left_on: str,
                     right_on: str, projection: Mapping[str, Column],
                     lookup_max_rows: int | None = 1_000_000) -> DataFrame:
    """Inner equi-join with a lookup table, then a typed projection.

    Unmatched rows vanish and several matches multiply, as an inner join does.
    ``projection`` maps output names to expressions over ``q.*`` / ``u.*``.
    The lookup side is broadcast only after a bounded row-count check; beyond
    it the join is planned as a shuffle join (AQE splits skewed keys).
    """
    u = lookup
    if lookup_max_rows is not None:
        u, _ = broadcast_if_small(lookup, lookup_max_rows)
    q = quarantined.alias("q")
    u = u.alias("u")
    joined = q.join(u, F.col(f"q.{left_on}") == F.col(f"u.{right_on}"), "inner")
    return joined.select(*[expr.alias(name) for name, expr in projection.items()])


class TypedRepair(NamedTuple):
    """What became of each quarantined row: three sets over one staged result, and their sizes."""

    repaired: DataFrame    # the projection, typed
    rejected: DataFrame    # the row, the projection's texts and the ``reasons``: columns that don't cast
    unmatched: DataFrame   # the row
    counts: dict[str, int]


def repair_typed(spark: SparkSession, quarantined: DataFrame, lookup: DataFrame, left_on: str, right_on: str,
                 projection: Mapping[str, tuple[Column, str]], lookup_max_rows: int = 1_000_000) -> TypedRepair:
    """J1 with X6 as ``try_cast``: no row vanishes and no bad value ends the job.

    ``projection`` maps output names to ``(expression over q.* / u.*, type)``.
    A row without a partner in ``lookup`` is unmatched (a NULL key has none).
    Of a row with partners each pairing is repaired if all its expressions
    cast to their types, else rejected with the names of those that don't; an
    expression that is NULL is a NULL of the type, not a failure. Join, casts and
    split are one pass, staged once; the three sets filter it.

    Bad keys don't fail the join either: both sides are compared as text.
    """
    q = quarantined.select(F.struct("*").alias("q"))
    u, _ = broadcast_if_small(lookup.select(F.struct("*").alias("u")), lookup_max_rows)
    match = F.col(f"q.{left_on}").cast("string") == F.col(f"u.{right_on}").cast("string")
    joined = q.join(u, match, "left")
    cast = {n: e.try_cast(t) for n, (e, t) in projection.items()}
    bad = {n: e.isNotNull() & cast[n].isNull() for n, (e, _) in projection.items()}
    outcome = (F.when(F.col("u").isNull(), UNMATCHED)
               .when(reduce(or_, bad.values(), F.lit(False)), REJECTED).otherwise(REPAIRED))
    told = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in bad.items()]))
    rows = joined.select(
        "q", outcome.alias("outcome"), told.alias("reasons"),
        F.struct(*[c.alias(n) for n, c in cast.items()]).alias("typed"),
        F.struct(*[e.cast("string").alias(n) for n, (e, _) in projection.items()]).alias("given"))
    staged, counts = stage_observed(spark, rows, "repair-typed", {
        k: F.count_if(F.col("outcome") == k) for k in (REPAIRED, REJECTED, UNMATCHED)})
    of = lambda k: staged.where(F.col("outcome") == k)
    return TypedRepair(of(REPAIRED).select("typed.*"), of(REJECTED).select("q", "given", "reasons"),
                       of(UNMATCHED).select("q.*"), counts)
