"""Exact deduplication against a persistent digest index.

Method: the index is a table bucketed and sorted by the SHA-256 digest of the
normalised text (ASCII white space deleted). New documents are grouped by
digest; the groups are sort-merge anti-joined with the index, which is already
dealt out by digest, and the new digests are appended to it.

Of equal texts, the row with the most code points in its original text stays;
then the smallest id (null last), then the first place in the input files.

Defined cases: a null text counts as empty; repeated rows are equal texts, of
which one stays; an empty table gives an empty result and leaves the index as
it is; further columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import FILE, KEYS, ROW, SPACES, keyed, scanned, staged, without
from strata.session import fresh_dir, unique_name

#: Buckets of a new index; a cluster sets about one for each 200 MB of index.
BUCKETS = 32


def digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without ASCII white space; null counts as empty."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, ""), 256))


class DigestIndex:
    """A Parquet table ``(digest, keep_id)``, bucketed and sorted by digest.

    ``path`` is a shared folder that outlives the session; a later session
    opens it again under another table name with the same number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, id_type: str = "bigint",
                 buckets: int = BUCKETS) -> None:
        self.spark, self.buckets = spark, buckets
        self.path = path or fresh_dir(spark, "digest-index")
        self.table = unique_name("digest_index")
        where = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}, "
            f"keep_chars BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{where}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, entries: DataFrame) -> None:
        """One sorted file for each bucket and batch."""
        (entries.select("digest", "keep_id", "keep_chars").repartition(self.buckets, "digest")
         .sortWithinPartitions("digest").write.format("parquet").mode("append")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)


def exact_dedup(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None,
                doc_id: str = "doc_id", text: str = "text", scan: bool = False) -> DataFrame:
    """A row for each document, keyed by row: ``doc_id, digest, keep_id, group_size, kept``.

    ``group_size`` counts the equal texts of this batch. With an ``index`` that
    already knows a digest, no row of the batch with it is kept, and
    ``keep_id`` is the document recorded in the index; new digests are appended.
    """
    index = index or DigestIndex(spark, id_type=docs.schema[doc_id].dataType.simpleString())
    body = F.col(f"`{text}`").cast("string")
    rows = staged(spark, keyed(
        spark, docs, F.col(f"`{doc_id}`").alias("doc_id"), digest(body).alias("digest"),
        F.coalesce(F.length(body), F.lit(0)).cast("long").alias("chars"), scan=scan), "digests")
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"),
                          "doc_id", *KEYS)).alias("best")
    groups = staged(spark, rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size"))
                    .select("digest", "group_size", F.col("best.doc_id").alias("first_id"),
                            (-F.col("best.less")).alias("chars"),
                            F.col(f"best.{FILE}").alias("best_file"),
                            F.col(f"best.{ROW}").alias("best_row")), "digest-groups")
    known = index.read().select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known"))
    verdict = staged(spark, groups.join(known.hint("merge"), "digest", "left")
                     .withColumn("known", F.coalesce("known", F.lit(False))), "digest-verdicts")
    # the anti-join: digests that the index has not seen
    fresh = staged(spark, groups.join(index.read().select("digest").hint("merge"), "digest",
                                      "left_anti"), "digests-new")
    index.append(fresh.select("digest", F.col("first_id").alias("keep_id"),
                              F.col("chars").alias("keep_chars")))
    return rows.join(verdict, "digest").select(
        *KEYS, "doc_id", "digest",
        F.when(F.col("known"), F.col("known_id")).otherwise(F.col("first_id")).alias("keep_id"),
        "group_size",
        (~F.col("known") & (F.col("best_file") == F.col(FILE))
         & (F.col("best_row") == F.col(ROW))).alias("kept"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None,
                      doc_id: str = "doc_id", text: str = "text", scan: bool = False) -> DataFrame:
    """``docs`` with one row of each group of equal texts; same columns."""
    docs = scanned(spark, docs, scan)
    found = exact_dedup(spark, docs, index, doc_id, text, scan=True)
    return without(spark, docs, staged(spark, found.where(~F.col("kept")).select(*KEYS), "copies"))
