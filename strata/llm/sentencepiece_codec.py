"""SentencePiece encoding and decoding with a given model file.

Method: shared-prefix Viterbi. The text is cut into marked words (a run of word
marks and what follows), and these where no piece runs from one character to the
next: the parts are encoded independently. The distinct words of a slice of
texts are sorted, which lays them out as the depth-first order of their trie,
and the forward table of a word is kept up to the prefix that it shares with
the next one, so a prefix is worked out once.

The forward state of a prefix depends on the model. A unigram model keeps the
best score and its last piece. A BPE model is not a best-score model; there the
state is the last piece of the prefix's own encoding, and a piece may follow it
only if the two, merged alone, come out as the same two pieces. Exactly one
last piece passes, and the path is that of the merges, so both kinds give the
model's own ids.

Defined cases: a null text gives null ids and decodes to null; an empty text
gives no ids; characters without a piece become byte pieces (or the unknown
piece, if the model has none); a literal word mark (U+2581) reads as a space,
as in the format itself; words of any length, empty tables and further columns
with any name are taken as they are. The model must use the identity
normaliser; any other is refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import flat_bytes, slices

#: Fixed values of the model file's format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Words whose ids a Python worker keeps from one slice to the next (twice as many at most).
KEPT_WORDS = 200_000
#: Bytes of text whose distinct words are encoded together.
SLICE_BYTES = 4_000_000
#: Ids that are decoded at once.
SLICE_IDS = 1_000_000
#: Piece pairs that it remembers.
KEPT_PAIRS = 500_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at:at + size]
            at += size


class Vocabulary:
    """Pieces, scores and settings of a model, from plain tables (see ``read_tables``).

    The tables travel as one broadcast, which a Python worker unpacks once; what
    the worker learns (``follows``, ``words``) stays in them from task to task.
    """

    def __init__(self, tables: dict) -> None:
        self.tables = tables
        self.pieces, self.kinds, self.scores = tables["pieces"], tables["kinds"], tables["scores"]
        self.model_type, self.dummy_prefix = tables["model_type"], tables["dummy_prefix"]
        self.ids, self.ends, self.bytes = tables["ids"], tables["ends"], tables["bytes"]
        self.unknown, self.cut = tables["unknown"], re.compile(tables["cut"], re.S)

    def outside(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        if len(self.bytes) < 256:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]


def merged(symbols: list[str], ids: dict[str, int], scores: list[float]) -> list[str]:
    """BPE by definition: the best-scored neighbouring pair is joined, leftmost first."""
    while len(symbols) > 1:
        top, at = None, -1
        for i in range(len(symbols) - 1):
            piece = ids.get(symbols[i] + symbols[i + 1])
            if piece is not None and (top is None or scores[piece] > top):
                top, at = scores[piece], i
        if at < 0:
            break
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


def read_tables(model: bytes) -> dict:
    """The tables of ``Vocabulary`` from a model file's bytes."""
    pieces, kinds, scores = [], [], []
    model_type, dummy, extra, charsmap = UNIGRAM, True, True, b""
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode("utf-8"))
            scores.append(float(np.frombuffer(own.get(2, b"\0\0\0\0"), "<f4")[0]))
            kinds.append(own.get(3, NORMAL))
        elif number == 2:
            model_type = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            charsmap, dummy, extra = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1))
    if charsmap or extra:
        raise ValueError("only models with the identity normaliser and kept white space are read")
    if model_type not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model_type} is neither unigram nor BPE")
    ids = {p: i for i, p in enumerate(pieces) if kinds[i] in (NORMAL, USER)}
    # a line feed that no longer piece holds ends a word, as the mark begins one
    stop = "" if any("\n" in p for p in ids if len(p) > 1) else "\n"
    cut = f"{MARK}*[^{MARK}{stop}]+|{MARK}+" + (f"|{stop}" if stop else "")
    if any(MARK in p.lstrip(MARK) for p in ids):
        cut = ".+"  # pieces run over words
    # lengths of the pieces that end in two given characters, the longest first; of
    # a BPE model, pieces that its own merges make
    ends: dict[str, set[int]] = {}
    for p in ids:
        if len(p) > 1 and (model_type == UNIGRAM or merged(list(p), ids, scores) == [p]):
            ends.setdefault(p[-2:], set()).add(len(p))
    return {
        "pieces": pieces, "kinds": kinds, "scores": scores, "model_type": model_type,
        "dummy_prefix": dummy, "ids": ids, "unknown": kinds.index(UNKNOWN), "cut": cut,
        "bytes": {int(pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == BYTE},
        "ends": {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()},
        "runs_on": byte_pairs(ids), "follows": {}, "words": {},
    }


class Encoder:
    """Encodes sorted words, sharing the forward table of common prefixes.

    In a table a piece is its id; a character without a piece is ``base`` and
    its code point.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.base = vocabulary, len(vocabulary.pieces)
        self.follows: dict[int, bool] = vocabulary.tables["follows"]
        known = [s for i, s in enumerate(vocabulary.scores) if vocabulary.kinds[i] == NORMAL]
        self.worst = min(known, default=0.0) - 10.0
        self.best = max(known, default=0.0)

    def may_follow(self, key: int, left: str, right: str) -> bool:
        if len(self.follows) > KEPT_PAIRS:
            self.follows.clear()
        ok = merged(list(left + right), self.v.ids, self.v.scores) == [left, right]
        self.follows[key] = ok
        return ok

    def _bpe(self, word: str, last: list[int], sizes: list[int], start: int) -> None:
        """Fills last[k], the last piece of the first k characters' encoding, from ``start`` + 1 on."""
        ids, ends, follows, base = self.v.ids.get, self.v.ends.get, self.follows.get, self.base
        for end in range(start + 1, len(word) + 1):
            for size in (*ends(word[end - 2:end] if end > 1 else "", ()), 1):
                if size > end:
                    continue
                piece = word[end - size:end]
                i = ids(piece)
                if i is None:
                    if size > 1:
                        continue
                    i = base + ord(piece)
                if size < end:
                    at = end - size
                    key = last[at] << 32 | i
                    ok = follows(key)
                    if ok is None:
                        ok = self.may_follow(key, word[at - sizes[at]:at], piece)
                    if not ok:
                        continue
                last[end], sizes[end] = i, size
                break
            else:
                raise AssertionError(f"no last piece for {word[:end]!r}")

    def _unigram(self, word: str, last: list[int], sizes: list[int], score: list[float], start: int) -> None:
        ids, ends, scores, kinds = self.v.ids.get, self.v.ends.get, self.v.scores, self.v.kinds
        for end in range(start + 1, len(word) + 1):
            top, best, length = score[end - 1] + self.worst, self.base + ord(word[end - 1]), 1
            for size in (1, *ends(word[end - 2:end] if end > 1 else "", ())):
                i = ids(word[end - size:end]) if size <= end else None
                if i is None:
                    continue
                own = self.best * size - 0.1 if kinds[i] == USER else scores[i]
                value = score[end - size] + own
                if value > top or size == 1:
                    top, best, length = value, i, size
            last[end], sizes[end], score[end] = best, length, top

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of each distinct word, as packed 32-bit integers."""
        out: dict[str, bytes] = {}
        last, sizes, score, before, base = [0], [0], [0.0], "", self.base
        unigram = self.v.model_type == UNIGRAM
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            more = len(word) - shared
            last[shared + 1:], sizes[shared + 1:] = [0] * more, [0] * more
            if unigram:
                score[shared + 1:] = [0.0] * more
                self._unigram(word, last, sizes, score, shared)
            else:
                self._bpe(word, last, sizes, shared)
            found: list[int] = []
            at = len(word)
            while at:
                i = last[at]
                if i < base:
                    found.append(i)
                else:
                    found.extend(reversed(self.v.outside(chr(i - base))))
                at -= sizes[at]
            found.reverse()
            out[word] = array("i", found).tobytes()
            before = word
        return out


class WordStore:
    """Encodes words and remembers the recent ones, in two generations of ``KEPT_WORDS``."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.encoder, self.kept = Encoder(vocabulary), vocabulary.tables["words"]

    def get(self, words: set[str]) -> dict[str, bytes]:
        """A table that holds all the words."""
        young, old = self.kept.setdefault("young", {}), self.kept.setdefault("old", {})
        if len(young) > KEPT_WORDS:
            young, old = {}, young
            self.kept |= {"young": young, "old": old}
        new = words - young.keys()
        young.update({w: old[w] for w in new & old.keys()})
        young.update(self.encoder.encode(new - old.keys()))
        return young


def _marked(text: str, vocabulary: Vocabulary) -> str:
    text = text.replace(" ", MARK)
    return MARK + text if text and vocabulary.dummy_prefix else text


def byte_pairs(pieces: Iterable[str]) -> np.ndarray:
    """Whether a piece may run on from a byte to the next (256 x 256), a space standing for the mark.

    Exact for two ASCII characters; all others count as one kind.
    """
    runs_on = np.zeros((256, 256), bool)
    runs_on[128:, 128:] = True
    kind = lambda c: 32 if c == MARK else ord(c) if c < "\x80" else slice(128, 256)
    for left, right in {pair for p in pieces for pair in zip(p, p[1:])}:
        runs_on[kind(left), kind(right)] = True
    return runs_on


def marked_words(texts: pa.Array, dummy_prefix: bool, runs_on: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All marked words in order, as bytes with spaces for marks, and the number of each one's text.

    A word begins at a text's first byte, which gets a space in front if the
    model asks for it, and where no piece runs on: at a run of spaces, and
    mostly at punctuation, digits and line feeds.
    """
    texts = pc.replace_substring(pc.fill_null(texts, ""), pattern=MARK, replacement=" ")
    if dummy_prefix:
        some = pc.greater(pc.binary_length(texts), 0)
        texts = pc.binary_join_element_wise(pc.if_else(some, " ", ""), texts, "")
    data, offsets = flat_bytes(texts)
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins[1:] |= ~runs_on[data[:-1], data[1:]]
    start = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, start, side="right") - 1
    return pa.Array.from_buffers(pa.binary(), len(start), [
        None, pa.py_buffer(np.append(start, len(data)).astype(np.int32)), pa.py_buffer(data)]), owner


def _encoder(tables: Broadcast) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tables.value)
        store, runs_on = WordStore(vocabulary), vocabulary.tables["runs_on"]
        for batch in slices(batches, "__llm_text", SLICE_BYTES):
            texts = batch.column("__llm_text")
            words, owner = marked_words(texts, vocabulary.dummy_prefix, runs_on)
            coded = words.dictionary_encode()
            distinct = [w.decode().replace(" ", MARK) for w in coded.dictionary.to_pylist()]
            ids_of = store.get(set(distinct))
            packed = [ids_of[w] for w in distinct]
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            table, code = np.frombuffer(b"".join(packed), np.int32), coded.indices.to_numpy()
            # each word's run of ids, in the order of the words
            size = sizes[code]
            ends = np.cumsum(size)
            first = (np.cumsum(sizes) - sizes)[code] - (ends - size) if len(code) else size
            flat = table[np.repeat(first, size) + np.arange(ends[-1] if len(ends) else 0)]
            offsets = np.zeros(len(texts) + 1, dtype=np.int32)
            np.cumsum(np.bincount(owner, size, len(texts)).astype(np.int64), out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pc.is_null(texts))
            others = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "__llm_text"]
            yield pa.RecordBatch.from_arrays([*others, ids], names=[
                *[n for n in batch.schema.names if n != "__llm_text"], "__llm_ids"])

    return encode


def _texts(ids: pa.ListArray, raw: list[bytes], pieces: pa.Array, dummy_prefix: bool) -> pa.Array:
    """The texts of lists of ids; bytes that are no UTF-8 become U+FFFD.

    ``pieces`` holds the pieces' bytes and, behind them, the same without a
    leading space, for the place where the model's own prefix stands.
    """
    size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, flat = np.cumsum(size), ids.flatten().to_numpy().astype(np.int64)
    first = (ends - size)[size > 0]
    lead = flat[first]
    if dummy_prefix:
        flat[first] += len(raw)
    try:
        if dummy_prefix and any(not raw[i] for i in np.unique(lead)):
            raise pa.ArrowInvalid("a silent piece leads")  # the prefix may stand behind it
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        out = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces.take(pa.array(flat))), b"").cast(pa.string())
    except pa.ArrowInvalid:
        flat[first] = lead
        texts = (b"".join(map(raw.__getitem__, flat[end - n:end])).decode("utf-8", "replace")
                 for end, n in zip(ends.tolist(), size.tolist(), strict=True))
        out = pa.array([t[1:] if dummy_prefix and t.startswith(" ") else t for t in texts], pa.string())
    return pc.if_else(pc.is_valid(ids), out, None)


def _decoder(tables: Broadcast) -> Callable:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(tables.value)
        silent = {i for i, k in enumerate(v.kinds) if k == CONTROL}
        raw = [p.replace(MARK, " ").encode() if k != BYTE else bytes([int(p[3:5], 16)])
               for p, k in zip(v.pieces, v.kinds, strict=True)]
        raw = [b"" if i in silent else b" \xe2\x81\x87 " if i == v.unknown else x for i, x in enumerate(raw)]
        pieces = pa.array(raw + [x[1:] if x[:1] == b" " else x for x in raw], pa.binary())
        for whole in batches:
            size = pc.fill_null(pc.list_value_length(whole.column("__llm_ids")), 0).to_numpy(zero_copy_only=False)
            before, start = np.cumsum(size, dtype=np.int64), 0
            while start < whole.num_rows:  # runs of rows of so many ids (one row at least)
                base = before[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(before, base + SLICE_IDS, side="right")))
                batch, start = whole.slice(start, stop - start), stop
                out = _texts(batch.column("__llm_ids"), raw, pieces, v.dummy_prefix)
                others = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "__llm_ids"]
                yield pa.RecordBatch.from_arrays([*others, out], names=[
                    *[n for n in batch.schema.names if n != "__llm_ids"], "__llm_text"])

    return decode


def read_model(path: str) -> bytes:
    """The model file's bytes, read once on the driver (a vocabulary: bounded by its file)."""
    with open(path, "rb") as f:
        return f.read()


def _shared(spark: SparkSession, model: bytes) -> Broadcast:
    return spark.sparkContext.broadcast(read_tables(model))


def _mapped(df: DataFrame, keep: list[str], column: str, inner: str, out: str, made: str,
            made_type: str, function: Callable) -> DataFrame:
    """``function`` over ``column`` with the columns ``keep`` beside it, whatever their names."""
    passed = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    types = ", ".join(f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    done = df.select(*passed, F.col(f"`{column}`").alias(inner)).mapInArrow(
        function, ", ".join(x for x in (types, f"{made} {made_type}") if x))
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col(made).alias(out))


def encode(spark: SparkSession, docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but ``text``) and ``ids``, the text's piece ids. No shuffle."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    return _mapped(docs, keep, text, "__llm_text", ids, "__llm_ids", "array<int>", _encoder(_shared(spark, model)))


def decode(spark: SparkSession, docs: DataFrame, model: bytes, ids: str = "ids", text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but ``ids``) and ``text``, decoded from the ids."""
    keep = [c for c in docs.columns if c != ids] if keep is None else keep
    return _mapped(docs, keep, ids, "__llm_ids", text, "__llm_text", "string", _decoder(_shared(spark, model)))
