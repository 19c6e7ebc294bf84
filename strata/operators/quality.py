"""The clean/quarantine split, null profile and schema checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.schemas import (
    MIN_BUDGET,
    MIN_RUNTIME_EXCLUSIVE,
    STATUS_LOADED,
    STATUS_NEW,
    STATUS_QUARANTINED,
)

OUTCOME = "outcome"


def clean_predicate(runtime: str = "RunTime", budget: str = "Budget",
                    min_runtime: int = MIN_RUNTIME_EXCLUSIVE,
                    min_budget: float = MIN_BUDGET) -> Column:
    """``RunTime > 0 AND Budget >= 1000000``."""
    return (F.col(runtime) > min_runtime) & (F.col(budget) >= min_budget)


def quarantine_predicate(runtime: str = "RunTime", budget: str = "Budget",
                         min_runtime: int = MIN_RUNTIME_EXCLUSIVE,
                         min_budget: float = MIN_BUDGET) -> Column:
    """``RunTime <= 0 OR Budget < 1000000``."""
    return (F.col(runtime) <= min_runtime) | (F.col(budget) < min_budget)


def outcome_column(runtime: str = "RunTime", budget: str = "Budget",
                   min_runtime: int = MIN_RUNTIME_EXCLUSIVE,
                   min_budget: float = MIN_BUDGET, nulls: str = "leave") -> Column:
    """One column carrying the split: ``loaded`` / ``quarantined`` / ``new``.

    Under three-valued logic a row can satisfy neither predicate (a NULL on
    the deciding side); such rows stay ``new`` (``nulls="leave"``, faithful) or
    go to quarantine (``nulls="quarantine"``).
    """
    if nulls not in ("leave", "quarantine"):
        raise ValueError("nulls must be 'leave' or 'quarantine'")
    rest = STATUS_NEW if nulls == "leave" else STATUS_QUARANTINED
    return (
        F.when(clean_predicate(runtime, budget, min_runtime, min_budget), F.lit(STATUS_LOADED))
        .when(quarantine_predicate(runtime, budget, min_runtime, min_budget), F.lit(STATUS_QUARANTINED))
        .otherwise(F.lit(rest))
    )


def classify(df: DataFrame, name: str = OUTCOME, **kw) -> DataFrame:
    """Add the outcome column (evaluated once per row)."""
    return df.withColumn(name, outcome_column(**kw))


def split(df: DataFrame, materialize: bool = False, **kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(clean, quarantine, unclassified)``; together they are the input as a bag.

    Each output is a filter over one outcome column. Lazily, each consumer
    re-evaluates the input (e.g. re-parses JSON); with ``materialize=True``
    the classified frame is staged once under the shared scratch root and
    the three outputs read those files. With ``nulls="quarantine"`` the
    unclassified output is empty.
    """
    c = df.withColumn(OUTCOME, outcome_column(**kw))
    if materialize:
        from strata.sinks.staging import stage

        c = stage(df.sparkSession, c, "split")

    def part(status: str) -> DataFrame:
        return c.where(F.col(OUTCOME) == status).drop(OUTCOME)

    unclassified = (part(STATUS_NEW) if kw.get("nulls", "leave") == "leave"
                    else c.where(F.lit(False)).drop(OUTCOME))
    return part(STATUS_LOADED), part(STATUS_QUARANTINED), unclassified


def all_present(columns: Sequence[str]) -> Column:
    """TRUE when none of ``columns`` is NULL."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``na.drop()``: any NULL in the considered columns drops the row."""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """F6 (A1 + A2 in one scan): ``n_rows`` and ``n_complete`` as one row."""
    cols = list(columns) if columns else df.columns
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(all_present(cols)).alias("n_complete"),
    )


def schema_diff(actual: StructType, expected: StructType, nullable: bool = True) -> list[str]:
    """Differences between two schemas as readable lines (empty when equal)."""
    out = []
    a, e = actual.fields, expected.fields
    if [f.name for f in a] != [f.name for f in e]:
        out.append(f"names {[f.name for f in a]} != {[f.name for f in e]}")
    for fa, fe in zip(a, e):
        if fa.dataType != fe.dataType:
            out.append(f"{fa.name}: {fa.dataType.simpleString()} != {fe.dataType.simpleString()}")
        if nullable and fa.nullable != fe.nullable:
            out.append(f"{fa.name}: nullable {fa.nullable} != {fe.nullable}")
    return out


def assert_schema(df: DataFrame, expected: StructType | str, nullable: bool = True) -> DataFrame:
    """V1/V2: raise ``AssertionError`` unless ``df``'s schema equals ``expected``.

    ``expected`` may be a DDL string; ``nullable=False`` ignores nullability
    (e.g. after a file round trip, where every column reads back nullable).
    """
    exp = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    diff = schema_diff(df.schema, exp, nullable)
    if diff:
        raise AssertionError("schema mismatch: " + "; ".join(diff))
    return df
