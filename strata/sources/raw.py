"""Raw envelope files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_if_small
from strata.schemas import RAW_ENVELOPE_DDL
from strata.session import fresh_dir
from strata.sinks.staging import stage

#: Column in which the JSON reader keeps a document that it could not parse.
CORRUPT = "__unparsed"
#: Why a document is rejected: broken, not of the schema, or followed by more text.
UNPARSED, UNFIT, TRAILING = "unparsed", "unfit", "trailing"
REASONS = (UNPARSED, UNFIT, TRAILING)


def _told(what: str, text: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"raw document {what}: "), F.substring(text, 1, 200)))


def kept_records(envelopes: DataFrame, key: str, rejects: str) -> DataFrame:
    """One row per record; a document in ``CORRUPT`` fails the query or is left out.

    The corrupt column is asked in the exploded expression, not in a filter: a
    filter pushed into the JSON scan loses documents that name a key twice.
    """
    if rejects not in ("fail", "skip"):
        raise ValueError("rejects is 'fail' or 'skip'")
    kind = envelopes.schema[key].dataType
    none = F.lit(None) if rejects == "skip" else _told("does not parse", F.col(CORRUPT))
    records: Column = F.when(F.col(CORRUPT).isNotNull(), none.cast(kind)).otherwise(F.col(key))
    return envelopes.select(F.explode(records).alias(key))


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines that hold anything but white space, as ``(path, document)``."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))
    return lines.where(~F.col("document").rlike(r"^\s*$"))


def _without_mark(text: Column) -> Column:
    """The text without a byte order mark in front, which the JSON reader passes over too."""
    return F.when(text.startswith("\ufeff"), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def one_document(text: Column) -> Column:
    """Whether the text is exactly one JSON value, from its first to its last character.

    The JSON reader stops at the end of the first value and never sees what
    follows. So the text is put into an object, in front of a field with a name
    that no file can hold (it is drawn for this call): the object's fields are
    exactly those two only if the text is one whole value. The scan goes over
    the value's tokens without building anything.
    """
    last = f"end-{uuid.uuid4().hex}"
    fields = F.json_object_keys(F.concat(F.lit('{"value":'), _without_mark(text), F.lit(f',"{last}":0}}')))
    return F.coalesce(fields == F.array(F.lit("value"), F.lit(last)), F.lit(False))


def reject_reason(text: Column, schema: str) -> Column:
    """Why a line is not accepted (``REASONS``), NULL if it is.

    The root may be an object, or an array of objects as the JSON reader allows.
    """
    plain = F.ltrim(_without_mark(text))
    inner = F.when(plain.startswith("["), plain).otherwise(F.concat(F.lit("["), plain, F.lit("]")))
    shape = f"value ARRAY<STRUCT<{schema}>>, {CORRUPT} STRING"
    parsed = F.from_json(F.concat(F.lit('{"value":'), inner, F.lit("}")), shape, {"columnNameOfCorruptRecord": CORRUPT})
    first = F.from_json(plain, f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    fits = parsed[CORRUPT].isNull() & F.coalesce(~F.exists(parsed["value"], lambda x: x.isNull()), F.lit(False))
    return (F.when(one_document(text), F.when(~fits, F.lit(UNFIT)))
            .when(first[CORRUPT].isNull(), F.lit(TRAILING)).otherwise(F.lit(UNPARSED)))


def _read_lines(spark: SparkSession, path: str | Sequence[str], key: str, schema: str, rejects: str) -> DataFrame:
    """The records of JSON lines, each line checked to hold exactly one document.

    The JSON scan gives the records (only it keeps their exact text), a text
    scan of the same files the check. ``fail``: the check is a filter that
    raises, part of the same plan, so nothing of the batch is committed.
    ``skip``: files without a rejected line are scanned as they are; of the
    others the accepted lines are written to the shared folder and scanned there.
    """
    r = spark.read.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT)
    lines = text_lines(spark, path)
    if rejects == "fail":
        told = _told("does not parse, or is not alone on its line", F.concat_ws(" ", "path", "document"))
        never = F.when(one_document(F.col("document")), F.lit(False)).otherwise(told.cast("boolean"))
        records = kept_records(r.json(path), key, rejects)
        return records.unionByName(lines.where(never).select(
            F.lit(None).cast(records.schema[key].dataType).alias(key)))
    judged = lines.withColumn("reason", reject_reason(F.col("document"), schema))
    marred = stage(spark, judged.where("reason IS NOT NULL").select("path").distinct(), "raw-marred")
    marred, _ = broadcast_if_small(marred)  # file names, as the scan's own file list holds them
    if marred.isEmpty():
        return kept_records(r.json(path), key, rejects)
    mended = fresh_dir(spark, "raw-mended")
    judged.join(marred, "path", "left_semi").where("reason IS NULL").select("document").write.text(mended)
    whole = r.json(path).withColumn("path", F.col("_metadata.file_path")).join(marred, "path", "left_anti")
    return kept_records(whole, key, rejects).unionByName(kept_records(r.json(mended), key, rejects))


def read_raw(spark: SparkSession, path: str | Sequence[str], key: str = "movie",
             schema: str = RAW_ENVELOPE_DDL, multiline: bool = False,
             encoding: str | None = None, rejects: str = "fail") -> DataFrame:
    """One row per array element, kept as its exact JSON source text.

    Explicit schema (no inference pass). A missing key or an empty array gives
    no row. A document that does not parse, or a line or file that holds
    anything but one document, fails the query, or with ``rejects="skip"`` is
    left out (``raw_rejects`` returns such documents); none is lost unnoticed.

    By default the files hold JSON lines, one document per line (the layout
    ``write_envelope`` produces): files split across tasks, and the same plan
    scans the lines a second time for the check. ``multiline=True``
    reads one possibly pretty-printed document per file: one task per file, the
    whole file in memory. That reader takes only the first document of a file,
    so the files are checked first (one pass). Both keep each record's text byte
    for byte.

    ``encoding`` (multi-line only): by default the charset is detected and
    each record keeps its exact source text. Declaring it (e.g. ``"UTF-8"``)
    made the multi-line reader about 10x faster here, but records are then
    re-serialized compactly: whitespace inside a pretty-printed record is
    dropped, which changes the text key. Use it only for compact documents.
    """
    if rejects not in ("fail", "skip"):
        raise ValueError("rejects is 'fail' or 'skip'")
    if not multiline:
        return _read_lines(spark, path, key, schema, rejects)
    r = spark.read.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT)
    r = r.option("multiLine", True)
    if encoding:
        r = r.option("encoding", encoding)
    bad = raw_rejects(spark, path, key, schema, multiline=True)
    if rejects == "fail":
        first = bad.limit(1).collect()
        if first:
            raise ValueError(f"{first[0].path} does not hold exactly one JSON document")
        return kept_records(r.json(path), key, rejects)
    docs = r.json(path).withColumn("__path", F.col("_metadata.file_path"))
    good = docs.join(bad.select(F.col("path").alias("__path")), "__path", "left_anti")
    return kept_records(good, key, rejects)


def raw_rejects(spark: SparkSession, path: str | Sequence[str], key: str = "movie",
                schema: str = RAW_ENVELOPE_DDL, multiline: bool = False) -> DataFrame:
    """Documents that ``read_raw`` does not accept: ``(path, document, reason)``.

    JSON lines: the lines that do not hold exactly one document of the schema.
    Multi-line: whole files that do not. ``reason`` is one of ``REASONS``.
    """
    if multiline:
        docs = spark.read.text(path, wholetext=True).select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))
    else:
        docs = text_lines(spark, path)
    # a text scan and from_json: the JSON scan does not answer for its corrupt column alone
    return docs.withColumn("reason", reject_reason(F.col("document"), schema)).where("reason IS NOT NULL")


def raw_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The files under ``path`` as rows ``(path, length, modificationTime)``.

    Only metadata columns are selected, so file contents are not read.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path)
            .select("path", "length", "modificationTime"))


def peek_raw(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` text lines under ``path`` (a peek; the limit is the feature)."""
    return spark.read.text(path).limit(n)
