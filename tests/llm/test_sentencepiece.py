import random
from array import array

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb2

from strata.llm.sentencepiece_codec import Encoder, Vocabulary, _marked, decode, encode, read_model, read_tables

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
TEXTS = ["", " ", "a", "Hello world", "  two  spaces \n\n\ttab\r\n", "漢字かな 😀👍🏽 zażółć", "a\u0000b", " " * 41 + "x",
         "<s> </s> <0x0A> <unk>", "x" * 400, "aaaa" * 30, "ﬁ Ａ é é", "word " * 3000, "y" * 20_000]


def texts(rng, n=200):
    parts = ["the", "tion", "ou", "ß", "ñ", "é", " ", "  ", "\n", "###", "!!", "A", "1", "27", "漢", ".", ",", "ing"]
    return TEXTS + ["".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(n)]


def test_ids_are_the_models_own(spark, documents):
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    all_texts = texts(random.Random(4))
    rows = [(i, t, "en", "s") for i, t in enumerate(all_texts)] + [(-1, None, "en", None)]
    docs, model = documents(rows, extra=("c0", "__llm_x")), read_model(MODEL)
    done = encode(spark, docs, model)
    assert done.columns == [c for c in docs.columns if c != "text"] + ["ids"]
    got = {r.doc_id: r.ids for r in done.collect()}
    assert got.pop(-1) is None
    assert got == dict(enumerate(own.encode(all_texts)))
    back = {r.doc_id: r.text for r in decode(spark, done, model).collect()}
    assert back.pop(-1) is None
    assert back == dict(enumerate(all_texts))


def test_unigram_viterbi():
    """The same pieces with unigram scores: the library's own best path has the same score."""
    proto = pb2.ModelProto()
    proto.ParseFromString(read_model(MODEL))
    rng = random.Random(9)
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = -2.0 - rng.random() * 10 / len(p.piece)
    model = proto.SerializeToString()
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    v = Vocabulary(read_tables(model))
    for t in texts(rng, 150):
        cut = v.cut.findall(_marked(t, v)) if t else []
        ids = Encoder(v).encode(set(cut))
        mine, want = [i for w in cut for i in array("i", ids[w])], own.encode(t)
        if mine != want:  # ties or unknown characters aside, the scores agree
            assert abs(sum(v.scores[i] for i in mine) - sum(v.scores[i] for i in want)) < 1e-3, t


def test_empty_table(spark, documents):
    assert encode(spark, documents([]), read_model(MODEL)).count() == 0


def test_other_normalisers_are_refused():
    proto = pb2.ModelProto()
    proto.ParseFromString(read_model(MODEL))
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        read_tables(proto.SerializeToString())
