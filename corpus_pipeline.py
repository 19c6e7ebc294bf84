"""Corpus pipeline: documents -> quality rules -> exact dedup -> near-dedup -> mix -> tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet under ``spark.checkpoint.dir`` and reads it back as the
next stage's ``docs``, so each stage sees all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import staged
from strata.llm.exact_dedup import drop_exact_copies
from strata.llm.minhash import drop_near_copies
from strata.llm.mixing import take_mix
from strata.llm.quality_rules import apply_quality_rules
from strata.llm.sentencepiece_codec import encode, read_model

#: SentencePiece model file, read on the driver.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents and boilerplate lines go."""
    return apply_quality_rules(spark, docs, scan=True)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_copies(spark, docs, scan=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return drop_near_copies(spark, docs, scan=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return take_mix(spark, docs, scan=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the text: ``doc_id, lang, source, n_chars, ids``."""
    return encode(spark, docs, read_model(MODEL))


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mix_sources", mixed),
    ("sentencepiece", tokens),
]

#: Consistent weighted sampling and token ids have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
