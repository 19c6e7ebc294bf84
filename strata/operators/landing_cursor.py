"""C4/O1 by a cursor: land batch after batch without rewriting the backlog.

``land_next_batch`` deletes each landed batch from the backlog, as the source
pipeline does, and so rewrites the leading day each time. Here the place up to
which rows are landed is kept instead: a cursor into the total order
``(month, day, hour, tie_breaker)``, NULLs first. A batch is the rows from one cursor
to the next; a partition (day) is removed once the cursor has passed it. Each row is
written once, into its batch, however many batches there are.

The next cursor is found by counting, never by a sort of the batch: counts of
the partitions (taken once), then counts of the hours in the partition where
the batch ends, then the place among the rows of that hour, by ranges of the
tie-breaker. The batch itself is a filter, so as many tasks write it as the
scan has.

State lies in ``<backlog>/_cursor`` (hidden from scans): the partitions' counts,
and a one-row record for each batch, of which the last stays. A batch's folder
is named by its number and overwritten, and the record is written after it: a
run that dies in between lands the same batch again, in the same place.

The backlog must not grow while it is being drained (the counts are taken at
the first batch), and the tie-breaker must be unique in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from strata.operators.landing import read_backlog
from strata.operators.merge import partition_dir, partition_predicate
from strata.schemas import LANDING_ORDER, LANDING_ROWS_PER_HOUR
from strata.sinks.files import child_names, path_exists, remove_path
from strata.sinks.staging import stage

PARTITIONS = ("month", "day")
#: Rows of one hour up to which their place is found by a bounded top-k, above by ranges.
TOP = 10_000


class Cursor(NamedTuple):
    """Where the landing stands: ``landed`` rows in ``number`` batches.

    ``part`` is the index of the partition that the cursor lies in and ``key``
    the hour and tie-breaker of the last row landed of it (None: none is).
    """

    number: int
    landed: int
    part: int
    key: tuple | None


def after_key(columns: Sequence[str], key: Sequence[Any]) -> Column:
    """Rows that come after ``key`` in the order of ``columns``, NULLs first."""
    out, same = F.lit(False), F.lit(True)
    for c, v in zip(columns, key, strict=True):
        more = F.col(c).isNotNull() if v is None else F.coalesce(F.col(c) > F.lit(v), F.lit(False))
        out, same = out | (same & more), same & F.col(c).eqNullSafe(F.lit(v))
    return out


def nth_value(spark: SparkSession, rows: DataFrame, columns: Sequence[str], n: int) -> tuple:
    """The values of ``columns`` in the ``n``-th row by them, for any ``n`` up to the row count.

    Up to ``TOP`` a bounded top-k. Beyond, the rows are staged in ranges of the
    columns, the ranges' counts (one number a partition) tell which range holds
    the row, and only that range is numbered.
    """
    from pyspark.sql import Window

    order = [F.col(c).asc() for c in columns]
    values = rows.select(*columns)
    if n <= TOP:
        return tuple(values.orderBy(*order).limit(n).collect()[-1])  # TOP keys at most
    ranged = stage(spark, values.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "nth-ranges")
    for r in ranged.groupBy("__range").count().orderBy("__range").collect():
        if n <= r["count"]:
            break
        n -= r["count"]
    number = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    own = ranged.where(F.col("__range") == r["__range"]).withColumn("__number", number)
    return tuple(own.where(F.col("__number") == n).select(*columns).collect()[0])


class Landing:
    """A backlog and its cursor. What lies in its state is read once and then kept up (one writer)."""

    def __init__(self, spark: SparkSession, path: str, tie_breaker: str | Sequence[str],
                 partition_by: Sequence[str] = PARTITIONS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.tie = [tie_breaker] if isinstance(tie_breaker, str) else list(tie_breaker)
        self.by = list(partition_by)
        if not self.tie:
            raise ValueError("landing needs a tie_breaker that is unique in the backlog")
        if self.by != list(LANDING_ORDER)[:len(self.by)] or not self.by:
            raise ValueError("the backlog's partition columns must lead the landing order")
        self.inner = [*LANDING_ORDER[len(self.by):], *self.tie]
        self.state = f"{self.path}/_cursor"
        self._parts: list | None = None
        self._schema: StructType | None = None
        self._at: Cursor | None = None

    # --- state

    def partitions(self) -> list:
        """``(partition values, n)`` in order, counted at the first call (one row a partition)."""
        if self._parts is not None:
            return self._parts
        kept = f"{self.state}/partitions"
        if not path_exists(self.spark, f"{kept}/_SUCCESS"):
            rows = read_backlog(self.spark, self.path, self.by)
            if rows is None:
                return []
            rows.groupBy(*self.by).agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(kept)
        self._parts = self.spark.read.parquet(kept).orderBy(*self.by).collect()
        return self._parts

    def _rows(self) -> DataFrame:
        """The backlog's files as they are, the partition columns as ``INT``."""
        if self._schema is None:
            rows = self.spark.read.option("recursiveFileLookup", True).parquet(self.path)
            self._schema = StructType([*rows.schema.fields, *[StructField(c, IntegerType()) for c in self.by]])
        return self.spark.read.schema(self._schema).parquet(self.path)

    def cursor(self) -> Cursor:
        if self._at is None:
            self._at = self._read_cursor()
            self._drop(self.partitions()[:self._at.part])  # left by a run that died after its record
        return self._at

    def _read_cursor(self) -> Cursor:
        done = [c for c in sorted(child_names(self.spark, self.state))
                if c.startswith("batch-") and path_exists(self.spark, f"{self.state}/{c}/_SUCCESS")]
        if not done:
            return Cursor(0, 0, 0, None)
        r = self.spark.read.parquet(f"{self.state}/{done[-1]}").collect()[0]
        return Cursor(r["number"], r["landed"], r["part"],
                      tuple(r[f"key_{i}"] for i in range(len(self.inner))) if r["has_key"] else None)

    def _move(self, to: Cursor) -> None:
        fields = [StructField("number", LongType()), StructField("landed", LongType()), StructField("part", LongType()),
                  StructField("has_key", IntegerType()),
                  *[StructField(f"key_{i}", self._schema[c].dataType) for i, c in enumerate(self.inner)]]
        key = to.key if to.key is not None else (None,) * len(self.inner)
        row = (to.number, to.landed, to.part, int(to.key is not None), *key)
        name = f"{self.state}/batch-{to.number:09d}"
        self.spark.createDataFrame([row], StructType(fields)).coalesce(1).write.mode("overwrite").parquet(name)
        if to.number > 1:
            remove_path(self.spark, f"{self.state}/batch-{to.number - 1:09d}")
        self._at = to

    def _drop(self, parts: list) -> None:
        for p in parts:
            remove_path(self.spark, partition_dir(self.spark, self.path, self.by, p))

    # --- batches

    def _span(self, rows: DataFrame, parts: list, start: Cursor, end: Cursor) -> DataFrame:
        """The rows after ``start`` up to ``end``; only the partitions between are read."""
        inside = parts[start.part:end.part + (end.key is not None)]
        out = rows.where(partition_predicate(self.by, inside))
        if start.key is not None:
            first = partition_predicate(self.by, [parts[start.part]])
            out = out.where(~first | after_key(self.inner, start.key))
        if end.key is not None:
            last = partition_predicate(self.by, [parts[end.part]])
            out = out.where(~last | ~after_key(self.inner, end.key))
        return out

    def remaining(self) -> DataFrame | None:
        """The rows not yet landed, or ``None`` when there are none."""
        parts, at = self.partitions(), self.cursor()
        if at.landed >= sum(p["n"] for p in parts):
            return None
        return self._span(self._rows(), parts, at, Cursor(0, 0, len(parts), None))

    def _cut(self, rows: DataFrame, parts: list, ends: list, landed: int) -> Cursor:
        """The cursor after the first ``landed`` rows: ``(0, landed, part, key)``."""
        part = next(i for i, end in enumerate(ends) if landed <= end)
        if landed == ends[part]:
            return Cursor(0, landed, part + 1, None)
        own = rows.where(partition_predicate(self.by, [parts[part]]))
        left, key = landed - (ends[part] - parts[part]["n"]), []
        for c in LANDING_ORDER[len(self.by):]:  # hours: 25 values at most
            for r in own.groupBy(c).count().orderBy(c).collect():
                if left <= r["count"]:
                    break
                left -= r["count"]
            own, key = own.where(F.col(c).eqNullSafe(F.lit(r[c]))), [*key, r[c]]
        return Cursor(0, landed, part, (*key, *nth_value(self.spark, own, self.tie, left)))

    def land(self, raw_dir: str, hours: int = 1, rows_per_hour: int = LANDING_ROWS_PER_HOUR) -> str | None:
        """C4: write the next ``rows_per_hour * hours`` rows as JSON lines, move the cursor.

        Returns the batch's folder, or ``None`` when all is landed.
        """
        parts, at = self.partitions(), self.cursor()
        ends = list(accumulate(p["n"] for p in parts))
        if not ends or at.landed >= ends[-1]:
            return None
        rows = self._rows()
        end = self._cut(rows, parts, ends, min(at.landed + rows_per_hour * hours, ends[-1]))
        out = f"{raw_dir.rstrip('/')}/batch-{at.number + 1:09d}"
        self._span(rows, parts, at, end).write.mode("overwrite").json(out)
        self._move(end._replace(number=at.number + 1))
        self._drop(parts[at.part:end.part])
        return out


def land_all(spark: SparkSession, landing_path: str, raw_dir: str, hours: int = 1,
             tie_breaker: str | Sequence[str] = (), rows_per_hour: int = LANDING_ROWS_PER_HOUR) -> list[str]:
    """Every batch until the backlog is empty; the batches' folders in order."""
    landing, out = Landing(spark, landing_path, tie_breaker), []
    while (batch := landing.land(raw_dir, hours, rows_per_hour)) is not None:
        out.append(batch)
    return out
