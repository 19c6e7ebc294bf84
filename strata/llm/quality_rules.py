"""Quality rules: base counts of a text, and lines that many documents of a host share.

Method: cross-document line frequency. Lines are normalised (white space runs
become one space, ASCII letters lower case) and hashed; for each host the
distinct documents (distinct texts) that hold a line are counted. A line above
the limit, the same at every size of a host, is boilerplate if, besides, a few
of those documents have mostly text of their own: without that second count a
group of near copies would make each other's whole text "boilerplate", and all
of them would go.
Boilerplate lines are removed; a document of which too little is left is
rejected.

Defined cases: a null text has no words and no lines (base rule fails); a null
host is a host of its own; repeated rows count as one text for the line limit
and each gets its own verdict; an empty table gives an empty result; further
columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import (
    FILE, KEYS, ROW, SPACE, WORD, keyed, lists, ranks, scanned, slices, staged, words_of,
)

# Fixed values of the base rules.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: A line is frequent in a host when more documents than this hold it.
MIN_DOCS = 20
#: A document vouches for a frequent line when frequent lines are under this share of it;
#: so many documents make it boilerplate.
OWN_SHARE = 0.5
VOUCHERS = 5
#: A document with less than this share of its words left is rejected.
MIN_LEFT_SHARE = 0.2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STATS = (f"{FILE} long, {ROW} long, doc_id %s, host long, content long, n_words long, word_chars long, "
          "n_symbols long, n_dup_lines long, n_repeat_words long, "
          "lines array<long>, line_words array<int>")


def normalised_line(line: Column) -> Column:
    """The form in which lines are compared; ``_normalise`` does the same in a task."""
    return F.translate(F.btrim(F.regexp_replace(line, SPACE + "+", " "), F.lit(" ")),
                       _UPPER, _LOWER)


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def _normalise(lines: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.utf8_trim(
        pc.replace_substring_regex(lines, pattern=SPACE + "+", replacement=" "), characters=" "))


def _hashes(lines: pa.Array) -> np.ndarray:
    """XXH64 with Spark's seed (42), as its ``xxhash64`` of a string gives."""
    raw = [xxhash.xxh64_intdigest(x, seed=42) for x in _normalise(lines).to_pylist()]
    return np.array(raw, dtype=np.uint64).view(np.int64)


def _repeat_words(codes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each text: words that lie in a 3-word window found twice or more in it."""
    if len(codes) < 3:
        return np.zeros(n, dtype=np.int64)
    size = int(codes.max()) + 1
    pair, _ = ranks(codes[:-1] * size + codes[1:])
    triple, _ = ranks(pair[:-1] * size + codes[2:])
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    window, found = ranks(triple[inside] * n + owner[inside])
    start = inside[np.bincount(window, minlength=found)[window] >= 2]
    mark = np.zeros(len(codes), dtype=bool)
    for k in range(3):
        mark[start + k] = True
    return np.bincount(owner[mark], minlength=n)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        n = batch.num_rows
        texts = pc.fill_null(batch.column("text"), "")
        words, owner = words_of(texts)
        n_words = np.bincount(owner, minlength=n)
        chars = np.bincount(owner, minlength=n, weights=pc.utf8_length(words).to_numpy(
            zero_copy_only=False)) if len(words) else np.zeros(n)
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        repeat = _repeat_words(codes, owner, n)

        parts = pc.split_pattern(texts, pattern="\n")
        line_owner, line = pc.list_parent_indices(parts), pc.list_flatten(parts)
        keep = pc.match_substring_regex(line, pattern=WORD)
        line, line_owner = line.filter(keep), line_owner.filter(keep).to_numpy(
            zero_copy_only=False).astype(np.int64)
        coded = line.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        _, first = np.unique(code * n + line_owner, return_index=True)
        lines_in = np.bincount(line_owner, minlength=n)
        distinct = np.bincount(line_owner[first], minlength=n)
        hashed = _hashes(coded.dictionary)[code] if len(code) else np.zeros(0, np.int64)
        in_line = pc.count_substring_regex(line, pattern=WORD).cast(pa.int32())
        yield pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in (FILE, ROW, "doc_id", "host", "content")],
            pa.array(n_words, pa.int64()), pa.array(chars.astype(np.int64)),
            pc.count_substring_regex(texts, pattern=SYMBOLS).cast(pa.int64()),
            pa.array(lines_in - distinct, pa.int64()), pa.array(repeat, pa.int64()),
            lists(pa.array(hashed), line_owner, n), lists(in_line, line_owner, n),
        ], names=[FILE, ROW, "doc_id", "host", "content", "n_words", "word_chars", "n_symbols",
                  "n_dup_lines", "n_repeat_words", "lines", "line_words"])


def text_stats(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               host: str = "source", scan: bool = False) -> DataFrame:
    """Staged: a row for each document with its base counts and its lines' hashes."""
    rows = keyed(spark, docs, F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{host}`")).alias("host"),
                 F.xxhash64(F.col(f"`{text}`")).alias("content"),
                 F.col(f"`{text}`").cast("string").alias("text"), scan=scan)
    schema = _STATS % docs.schema[doc_id].dataType.simpleString()
    return staged(spark, rows.mapInArrow(_stats, schema), "line-stats")


def boilerplate(spark: SparkSession, stats: DataFrame, min_docs: int = MIN_DOCS,
                vouchers: int = VOUCHERS, own_share: float = OWN_SHARE) -> DataFrame:
    """Staged: the boilerplate lines of each document that has some.

    Columns: the row keys, ``line`` (hash) and ``words`` (of all its occurrences
    in the document). Counts are distinct texts, aggregated in part before each
    shuffle; the joins are on (host, line), whose hot keys the planner may split.
    """
    lines = (
        stats.select(*KEYS, "host", "content", "n_words",
                     F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
        .select(*KEYS, "host", "content", "n_words", F.col("x.lines").alias("line"),
                F.col("x.line_words").alias("words"))
        .withColumn("key", F.xxhash64("host", "line"))
    )
    counts = lines.groupBy("host", "line", "key").agg(F.count_distinct("content").alias("docs"))
    frequent = staged(spark, counts.where(F.col("docs") > min_docs).select("key"), "frequent-lines")
    found = staged(
        spark,
        lines.join(frequent, "key").select(*KEYS, "key", "line", "words", "content", "n_words"),
        "lines-found",
    )
    own = (found.groupBy(*KEYS, "n_words").agg(F.sum("words").alias("shared"))
           .where(F.col("shared") < F.col("n_words") * own_share).select(*KEYS))
    vouched = staged(
        spark,
        found.join(own, list(KEYS), "left_semi").groupBy("key")
        .agg(F.count_distinct("content").alias("docs")).where(F.col("docs") >= vouchers).select("key"),
        "boilerplate-lines",
    )
    return staged(spark, found.join(vouched, "key", "left_semi").groupBy(*KEYS, "line")
                  .agg(F.sum("words").alias("words")), "boilerplate")


def quality_rules(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", host: str = "source", min_docs: int = MIN_DOCS,
                  vouchers: int = VOUCHERS, own_share: float = OWN_SHARE, min_left_share: float = MIN_LEFT_SHARE,
                  scan: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(verdicts, lines)``, both staged and keyed by row.

    ``verdicts``: a row for each document with its base counts, ``left_words``,
    ``base_failed`` and ``kept``. ``lines``: see ``boilerplate``.
    """
    stats = text_stats(spark, docs, doc_id, text, host, scan=scan)
    lines = boilerplate(spark, stats, min_docs, vouchers, own_share)
    gone = lines.groupBy(*KEYS).agg(F.sum("words").alias("gone"))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    verdicts = (
        stats.drop("lines", "line_words", "host", "content").join(gone, list(KEYS), "left")
        .withColumn("left_words", F.col("n_words") - F.coalesce("gone", F.lit(0))).drop("gone")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed")
                    & (F.col("left_words") >= min_left_share * F.col("n_words")))
    )
    return staged(spark, verdicts, "quality"), lines


def apply_quality_rules(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id",
                        text: str = "text", host: str = "source", n_chars: str | None = "n_chars",
                        scan: bool = False, **limits: float) -> DataFrame:
    """``docs`` without rejected documents, and without the boilerplate lines of the others.

    Same columns. A text that loses lines gets its new length in ``n_chars``;
    all other texts stay as they are, byte for byte.
    """
    docs = scanned(spark, docs, scan)
    verdicts, lines = quality_rules(spark, docs, doc_id, text, host, scan=True, **limits)
    removed = lines.groupBy(*KEYS).agg(F.collect_set("line").alias("removed"))
    change = staged(
        spark,
        verdicts.select(*KEYS, "kept").join(removed, list(KEYS), "left")
        .where(~F.col("kept") | F.col("removed").isNotNull())
        .select(*KEYS, F.col("kept").alias("__llm_kept"), F.col("removed").alias("__llm_removed")),
        "quality-changes",
    )
    full = keyed(spark, docs, *[F.col(f"`{c}`") for c in docs.columns], scan=True)
    # sort-merge at every size, as in ``without``
    out = full.join(change.hint("merge"), list(KEYS), "left").where(F.coalesce("__llm_kept", F.lit(True)))
    old = F.col(f"`{text}`")
    short = F.array_join(F.filter(F.split(old, "\n", -1), lambda x: ~F.array_contains(
        F.col("__llm_removed"), line_hash(x))), "\n")
    changed = F.col("__llm_removed").isNotNull()
    columns = {c: F.col(f"`{c}`") for c in docs.columns}
    columns[text] = F.when(changed, short).otherwise(old)
    if n_chars and n_chars in columns:
        columns[n_chars] = F.when(changed, F.length(short)).otherwise(columns[n_chars]).cast(
            docs.schema[n_chars].dataType)
    return out.select(*[v.alias(c) for c, v in columns.items()])
