import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import registry

SF = "/root/testdata/sf0.001"
#: The contract's columns and types; op3, op6 and op10 have no fixed contract.
COLUMNS = {
    "op1_html_extract": "page_id bigint, url string, text string, n_chars bigint",
    "op2_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op3_minhash_near_dedup": "doc_id bigint, class_id bigint",
    "op4_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op6_sentencepiece": "doc_id bigint, ids array<int>",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                         "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op10_url_filter": "page_id bigint, url string, blocked boolean",
    "op11_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op12_centroid_clusters": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
                              "centroid_sha256 string",
    "op13_importance_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}


def test_one_query_for_each_operator():
    assert set(registry.queries()) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_a_row_for_each_row(spark, name):
    df = registry.queries()[name](spark, SF)
    types = dict(df.dtypes)
    for column in COLUMNS[name].split(", "):
        key, kind = column.split(" ")
        assert types[key] == kind, column
    key = next(k for k in ("page_id", "vec_id", "doc_id") if k in types)
    table = {"page_id": "pages", "vec_id": "embeddings", "doc_id": "documents"}[key]
    source = spark.read.parquet(f"{SF}/{table}.parquet")
    rows = df.groupBy(key).count()
    assert rows.where("count <> 1").count() == 0 and rows.count() == source.count()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    key = lambda rows: sorted(rows, key=repr)
    assert key(tuple(r[c] for c in cols) for r in df.collect()) == key(tuple(r[i] for i in at) for r in rel.fetchall())


def test_held_out_predictions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = registry.op2_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()[0][0]
    assert right > 0.97


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert times and max(times.values()) <= 3 and set(times) <= {r.doc_id for r in docs.select("doc_id").collect()}
    kept = corpus_pipeline.quality(spark, docs, SF)
    wanted = {r.doc_id for r in registry.op7_quality_rules(spark, SF).where("kept").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == wanted
