"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query reads its whole table, applies the operator with its production
parameters and returns a row for each row of the table, in the contract's
columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.centroids import cluster
from strata.llm.exact_dedup import exact_dedup
from strata.llm.html_extract import extract, train
from strata.llm.importance import draw, scored
from strata.llm.langid import identify
from strata.llm.langid import learn as learn_languages
from strata.llm.minhash import near_classes
from strata.llm.mixing import mix
from strata.llm.oracles import RESAMPLING_SQL, kmeans_sql
from strata.llm.quality_rules import quality_rules
from strata.llm.sentencepiece_codec import decode, encode, read_model
from strata.llm.token_counts import token_counts
from strata.llm.toxicity import THRESHOLD, score
from strata.llm.toxicity import learn as learn_toxicity
from strata.llm.url_filter import filter_urls, url_host
from strata.llm.warc import capture_records, page_of, read_warc, write_warc
from strata.session import fresh_dir

#: The model file of the SentencePiece query.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id is not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def op1_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    texts = extract(spark, _read(spark, sf, "pages"), train(), F.col("page_id"), F.col("url"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = _read(spark, sf, "documents"), _held_out("doc_id", 4, 2)
    dictionaries = learn_languages(spark, docs.where(~held))
    return identify(docs, dictionaries, F.col("doc_id"), held.alias("held_out"))


def op3_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = near_classes(spark, _read(spark, sf, "documents"), scan=True)
    return found.select("doc_id", "class_id", "class_size", "kept")


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Write the pages as archives, read the archives back."""
    path = fresh_dir(spark, "warc")
    write_warc(capture_records(spark, _read(spark, sf, "pages"), scan=True), path)
    found = read_warc(spark, path, payloads=False)
    number = lambda c: page_of(F.col(c)).cast("long")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"), "url", "error")


def op5_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix(spark, _read(spark, sf, "documents"), scan=True)
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs, model = _read(spark, sf, "documents"), read_model(PIECE_MODEL)
    ids = encode(spark, docs.select("doc_id", "text", F.xxhash64("text").alias("hash")), model)
    back = decode(spark, ids.withColumn("ids2", F.col("ids")), model, ids="ids2", text="back")
    return back.select("doc_id", "ids", F.size("ids").alias("n_ids"),
                       (F.xxhash64("back") == F.col("hash")).alias("round_trip"))


def op7_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    verdicts, _ = quality_rules(spark, _read(spark, sf, "documents"), scan=True)
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "left_words")


def op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = exact_dedup(spark, _read(spark, sf, "documents"), scan=True)
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, held = _read(spark, sf, "documents"), _held_out("doc_id", 3, 1)
    model = learn_toxicity(docs.where(~held), _read(spark, sf, "labels").where(~held))
    return score(docs, model, F.col("doc_id"), held.alias("held_out")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def _hex_number(text: Column) -> Column:
    """The first 8 hex digits of the text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries drawn from the pages' own hosts, parent domains and first path steps.

    Each pattern has several dated entries, as lists of successive dates would.
    """
    host = url_host(F.col("url"))
    step = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)/", 1)
    made = F.array(
        F.struct(host.alias("pattern"), F.lit(4).alias("n")),
        F.struct(F.regexp_extract(host, r"^[^.]+\.(.+)$", 1).alias("pattern"), F.lit(3).alias("n")),
        F.struct(F.when(step != "", F.concat(host, F.lit("/"), step, F.lit("/"))).alias("pattern"), F.lit(2).alias("n")))
    patterns = pages.where(host.isNotNull()).select(F.explode(made).alias("x")).select("x.*").where(
        "pattern <> ''").distinct()
    turn = F.concat("pattern", F.lit("#"), F.col("turn").cast("string"))
    return (patterns.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("pattern", F.timestamp_seconds(EPOCH + 86400 * (_hex_number(turn) % DAYS)).alias("listed_at"),
                    F.element_at(F.array(F.lit("block"), F.lit("remove"), F.lit("allow"), F.lit("block")),
                                 (_hex_number(F.concat(turn, F.lit("a"))) % 4 + 1).cast("int")).alias("action")))


#: Captures and lists of the URL filter's query lie in these days from 2023-01-01.
EPOCH, DAYS = 1672531200, 730


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Every page, fetched at a time that its id gives, against the entries active then."""
    pages = _read(spark, sf, "pages")
    fetched = F.timestamp_seconds(EPOCH + F.pmod(F.col("page_id") * 7919 * 61, F.lit(DAYS * 86400)))
    seconds = lambda c: F.unix_seconds(c)
    found = filter_urls(spark, pages.withColumn("fetched_at", fetched), list_entries(pages), "url", "fetched_at",
                        F.col("page_id"), F.col("url"), scan=True)
    return found.select("page_id", "url", "blocked", "pattern", "action", seconds("valid_from").alias("valid_from"),
                        seconds("valid_to").alias("valid_to"))


def op11_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(spark, _read(spark, sf, "documents"), read_model(PIECE_MODEL), F.col("doc_id"))


def op12_centroid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return cluster(spark, _read(spark, sf, "embeddings"))[0]


def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    scores = scored(spark, _read(spark, sf, "documents"), _read(spark, sf, "benchmark"))
    return draw(spark, scores).withColumnRenamed("id", "doc_id")


OP10_SQL = r"""
WITH hosts AS (
  SELECT page_id, url, 1672531200 + (page_id * 7919 * 61) % 63072000 AS t,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '.'), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
patterns AS (
  SELECT DISTINCT pattern, n FROM (
    SELECT host AS pattern, 4 AS n FROM hosts
    UNION ALL SELECT regexp_extract(host, '^[^.]+\.(.+)$', 1), 3 FROM hosts
    UNION ALL SELECT host || '/' || nullif(regexp_extract(path, '^/([^/]+)/', 1), '') || '/', 2 FROM hosts)
  WHERE pattern <> ''),
turns AS (SELECT pattern, unnest(range(1, n + 1)) AS turn FROM patterns),
entries AS (
  SELECT pattern,
         1672531200 + 86400 * (('0x' || substr(md5(pattern || '#' || turn), 1, 8))::BIGINT % 730) AS f,
         CASE ('0x' || substr(md5(pattern || '#' || turn || 'a'), 1, 8))::BIGINT % 4
              WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS rank
  FROM turns),
held AS (
  SELECT pattern, f, max(rank) AS rank,
         lead(f) OVER (PARTITION BY pattern ORDER BY f) AS u
  FROM entries GROUP BY pattern, f),
labels AS (SELECT page_id, t, host, string_split(host, '.') AS l, path, string_split(path, '/') AS s FROM hosts WHERE host IS NOT NULL),
keys AS (
  SELECT page_id, t, array_to_string(l[i:], '.') AS pattern FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM labels)
  UNION
  SELECT page_id, t, host || array_to_string(s[:i], '/') || CASE WHEN i < len(s) THEN '/' ELSE '' END
  FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM labels)),
best AS (
  SELECT page_id, k.pattern, rank, f, u,
         row_number() OVER (PARTITION BY page_id ORDER BY length(k.pattern) DESC, k.pattern DESC) AS place
  FROM keys k JOIN held h ON k.pattern = h.pattern AND k.t >= h.f AND (h.u IS NULL OR k.t < h.u)
  WHERE rank > 0)
SELECT p.page_id, p.url, coalesce(b.rank = 2, false) AS blocked, b.pattern,
       CASE b.rank WHEN 2 THEN 'block' WHEN 1 THEN 'allow' END AS action,
       b.f AS valid_from, b.u AS valid_to
FROM pages p LEFT JOIN best b ON p.page_id = b.page_id AND b.place = 1
"""


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""


def queries() -> dict[str, Query]:
    return {
        "op1_html_extract": op1_html_extract,
        "op2_language_id": op2_language_id,
        "op3_minhash_near_dedup": op3_minhash_near_dedup,
        "op4_warc": op4_warc,
        "op5_mix_sources": op5_mix_sources,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_quality_rules": op7_quality_rules,
        "op8_toxicity": op8_toxicity,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_url_filter": op10_url_filter,
        "op11_token_counts": op11_token_counts,
        "op12_centroid_clusters": op12_centroid_clusters,
        "op13_importance_resampling": op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": OP9_SQL, "op10_url_filter": OP10_SQL, "op12_centroid_clusters": kmeans_sql(),
            "op13_importance_resampling": RESAMPLING_SQL}
