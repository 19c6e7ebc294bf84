"""K8/K9: register tables at a location; create and select a database."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _literal(value) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _location(spark: SparkSession, table: str) -> str | None:
    """Where a table's files lie, ``None`` if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_q(table)}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def _same_place(a: str, b: str) -> bool:
    plain = lambda p: "/" + re.sub(r"^file:/*", "", p).strip("/") if re.match(r"file:|/", p) else p.rstrip("/")
    return plain(a) == plain(b)


def register_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet",
                   partitioned: bool = True, partitions: Iterable[Mapping[str, object]] | None = None) -> None:
    """K8: a catalog table over the files at ``path`` (external).

    A table that is already there, at the same place, is never dropped, so
    readers always find it: ``partitions`` (column values that a write
    reports) are added to it, those it has are passed over; without a report its folders
    are listed for new ones. A table of that name at another place is replaced, as the
    source pipeline does: dropped (its files stay) and created. A partitioned Parquet
    table shows no rows of a partition that it has not been told of.
    """
    there = _location(spark, table)
    if there is not None and not _same_place(there, path):
        spark.sql(f"DROP TABLE IF EXISTS {_q(table)}")
        there = None
    if there is None:
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(table)} USING {fmt} LOCATION '{where}'")
        partitions = None  # all folders are new to it
    if partitioned and fmt != "delta":
        if partitions is not None:
            told = [", ".join(f"`{c}` = {_literal(v)}" for c, v in p.items()) for p in partitions]
            for i in range(0, len(told), 500):
                added = " ".join(f"PARTITION ({p})" for p in told[i:i + 500])
                spark.sql(f"ALTER TABLE {_q(table)} ADD IF NOT EXISTS {added}")
        else:
            try:
                spark.catalog.recoverPartitions(table)
            except Exception as exc:  # unpartitioned table
                if "not partitioned" not in str(exc).lower() and "NOT_PARTITIONED" not in str(exc):
                    raise
    spark.catalog.refreshTable(table)


def use_database(spark: SparkSession, name: str) -> None:
    """K9: ``CREATE DATABASE IF NOT EXISTS``; ``USE``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(name)}")
    spark.sql(f"USE {_q(name)}")
