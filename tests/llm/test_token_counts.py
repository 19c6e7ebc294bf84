import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb2

from strata.llm.sentencepiece_codec import read_model
from strata.llm.token_counts import count_tokens, read_merges, token_counts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
OWN = sentencepiece.SentencePieceProcessor(model_file=MODEL)
MERGES = read_merges(read_model(MODEL))
ODD = ["", " ", "  ", "a", "▁", " ▁ a▁b", "\n\n\t", "<s> </s> <0x0A> <unk>", "a\u0000b", "y" * 30_001, "aaaa bbb " * 999,
       "漢字かな 😀👍🏽 zażółć", "x" + " " * 41, "é é ﬁ Ａ"]


def mine(texts):
    return count_tokens(pa.array(texts, pa.string()), MERGES).tolist()


def library(texts):
    return [len(x) for x in OWN.encode([t or "" for t in texts])]


@pytest.mark.parametrize("parts", [
    ["the", "tion", "ou", "ß", " ", "  ", "\n", "###", "A", "1", "27", "漢", ".", "ing", "▁", "er", "😀", "<s>"],
    list("abcdefghijklmnopqrstuvwxyz"), list("aet"), list("-=_ "), ["a", "aa", "b", " "]])
def test_counts_are_the_librarys(parts):
    rng = random.Random(str(parts))
    texts = ["".join(rng.choices(parts, k=rng.randrange(120))) for _ in range(1500)] + ODD
    assert mine(texts) == library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6))
def test_any_characters(texts):
    assert mine(texts) == library(texts)


def test_long_word_without_spaces():
    text = "".join(random.Random(1).choices("etaoinshrdlu", k=200_000))
    assert mine([text, "end"]) == library([text, "end"])


def test_order_of_merges_matters():
    """Scores under which a merge makes a pair that goes before the next place of its own pair."""
    proto = pb2.ModelProto()
    proto.ParseFromString(read_model(MODEL))
    rng = random.Random(3)
    for p in proto.pieces:
        if p.type == 1 and len(p.piece) > 1:
            p.score = -rng.random() * 1e4
    data = proto.SerializeToString()
    own = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["".join(rng.choices(["er", "in", "a", "t", "e", "th", "on", " "], k=rng.randrange(1, 60))) for _ in range(1500)]
    got = count_tokens(pa.array(texts), read_merges(data)).tolist()
    assert got == [len(x) for x in own.encode(texts)]


def test_sliced_array_and_nulls():
    whole = pa.array(["x y", None, "hello there", "", "z"])
    assert count_tokens(whole.slice(1, 3), MERGES).tolist() == library(["", "hello there", ""])
    assert count_tokens(pa.array([], pa.string()), MERGES).tolist() == []
    assert isinstance(count_tokens(whole, MERGES), np.ndarray)


def test_query_columns(spark, documents):
    rows = [(i, t, "en", "s") for i, t in enumerate(ODD)] + [(-1, None, None, None), (0, "", "en", "s"), (None, "a b", "en", "s")]
    docs = documents(rows, extra=("n_tokens", "c0", "__llm_words"))
    got = token_counts(spark, docs, read_model(MODEL), F.col("doc_id"), F.col("n_tokens").alias("x"))
    assert got.columns == ["doc_id", "x", "n_bytes", "n_tokens", "over_limit"]
    want = sorted((repr(i), len((t or "").encode()), n, n > 4096)
                  for (i, t, *_), n in zip(rows, library([r[1] for r in rows]), strict=True))
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want
    assert token_counts(spark, documents([]), read_model(MODEL), F.col("doc_id")).count() == 0


def test_refused_models():
    proto = pb2.ModelProto()
    proto.ParseFromString(read_model(MODEL))
    proto.pieces[400].type = 4
    with pytest.raises(ValueError):
        read_merges(proto.SerializeToString())
    proto.pieces[400].type = 1
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        read_merges(proto.SerializeToString())
