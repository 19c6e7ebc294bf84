"""Token counts of whole texts under a BPE model file, without building the tokens.

Method: rank-synchronous array merging. A slice of texts is cut into marked
words, and its distinct words lie in one ragged array of symbols, to begin with
their characters. A round finds the lowest-rank neighbouring pair of every
sequence and merges it in all sequences at once. The symbols that survive are
the tokens, so a word's count is its characters less its merges, and a text's
count is the sum over its words.

A round merges a pair at all its places in a sequence (of overlapping places,
every other one from the left). The model's own order takes the places one by
one, and a new neighbour pair of lower rank would go first. So the new pairs of
each place are looked up, and behind the first place that makes such a pair the
rest of the sequence waits for the next round: the result is always that of the
merges one by one.

Two characters that stand side by side in no piece can never be in one symbol.
Sequences are cut there first, which bounds the rounds of long words.

Defined cases: a null or empty text has no tokens; a character without a piece
counts as its UTF-8 bytes; a literal word mark (U+2581) reads as a space;
strings of special pieces inside a text are ordinary characters, as in the
library; no begin or end tokens, no truncation. Repeated rows, empty tables and
further columns with any name are taken as they are. Refused: unigram models,
models without byte pieces, models with user-defined pieces, other normalisers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import flat_bytes, slices
from strata.llm.sentencepiece_codec import BPE, MARK, USER, read_tables

#: Bytes of text whose distinct words are merged together.
SLICE_BYTES = 4_000_000
#: Rank of a pair that no piece allows.
NEVER = np.int32(2**31 - 1)


class Merges(NamedTuple):
    """What the merges need, as plain arrays (size fixed by the model file).

    ``keys`` are the sorted pairs of symbols (``left << 32 | right``) that make
    a piece, ``ranks`` and ``made`` its rank and symbol; ``beside`` are the sorted pairs
    of characters that stand side by side in some piece. ``chars`` and
    ``symbols`` map code points. ``whole`` says that pieces run over words.
    """

    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    beside: np.ndarray
    chars: np.ndarray
    symbols: np.ndarray
    dummy_prefix: bool
    whole: bool


def read_merges(model: bytes) -> Merges:
    """The arrays of ``Merges`` from a SentencePiece BPE model file's bytes."""
    tables = read_tables(model)
    if tables["model_type"] != BPE:
        raise ValueError("ranks need a BPE model")
    if USER in tables["kinds"] or len(tables["bytes"]) != 256:
        raise ValueError("only models with byte pieces and without user-defined pieces are read")
    ids, scores = tables["ids"], tables["scores"]
    order = {s: n for n, s in enumerate(sorted({scores[i] for i in ids.values()}, reverse=True))}
    pairs, beside = [], set()
    for piece, i in ids.items():
        for at in range(1, len(piece)):
            beside.add(ord(piece[at - 1]) << 32 | ord(piece[at]))
            left, right = ids.get(piece[:at]), ids.get(piece[at:])
            # a character without a piece of its own is never merged: it is cut off first
            if left is not None and right is not None:
                pairs.append((left << 32 | right, order[scores[i]], i))
    table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
    chars = np.array(sorted((ord(p), i) for p, i in ids.items() if len(p) == 1), dtype=np.int64).reshape(-1, 2)
    return Merges(
        table[:, 0].copy(), np.append(table[:, 1].astype(np.int32), NEVER), table[:, 2].astype(np.int32),
        np.array(sorted(beside), dtype=np.int64), chars[:, 0].copy(), chars[:, 1].astype(np.int32),
        tables["dummy_prefix"], any(MARK in p.lstrip(MARK) for p in ids))


def _found(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each key in the sorted table, -1 if it isn't there."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    at[table[at] != keys] = -1
    return at


def _pairs(m: Merges, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The place in ``m.keys`` of each pair of symbols, -1 if it makes no piece."""
    return _found(m.keys, left.astype(np.int64) << 32 | right)


def _every_other(at: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring places the first, third, fifth and so on."""
    number = np.arange(len(at))
    first = np.append(True, np.diff(at) > 1)
    return at[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]


def _upto_first(bad: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Mask of the entries before or at the first bad one of their group (``group`` ascends)."""
    before = np.cumsum(bad) - bad
    start = np.append(True, group[1:] != group[:-1])
    base = np.maximum.accumulate(np.where(start, before, 0))
    return before == base


def surviving(words: pa.Array, m: Merges) -> np.ndarray:
    """The number of symbols left of each word (binary array; its spaces are word marks)."""
    data, offsets = flat_bytes(words)
    lead = (data & 0xC0) != 0x80
    at_char = np.append(0, np.cumsum(lead))[offsets]
    # characters: code points, the word of each, the tokens of each before any merge
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    points[points == 32] = ord(MARK)
    owner = np.repeat(np.arange(len(words)), np.diff(at_char))
    known = _found(m.chars, points)
    n_bytes = np.diff(np.append(np.flatnonzero(lead), len(data)))
    n_bytes[(points == ord(MARK))] = len(MARK.encode())
    left = np.bincount(owner, np.where(known >= 0, 1, n_bytes), len(words)).astype(np.int64)
    if len(points) < 2:
        return left
    # cut between words, beside unknown characters and where no piece runs on
    stop = np.ones(len(points), bool)
    stop[:-1] = ((owner[1:] != owner[:-1]) | (known[1:] < 0) | (known[:-1] < 0)
                 | (_found(m.beside, points[:-1] << 32 | points[1:]) < 0))
    symbol = m.symbols[known]
    pair = np.full(len(points), -1, np.int64)
    inner = np.flatnonzero(~stop)
    pair[inner] = _pairs(m, symbol[inner], symbol[inner + 1])
    while True:
        ends = np.flatnonzero(stop)
        starts = np.append(0, ends[:-1] + 1)
        rank = m.ranks[pair]
        least = np.minimum.reduceat(rank, starts)
        sizes = ends - starts + 1
        live = least < NEVER
        if not live.any():
            return left
        if 4 * sizes[live].sum() < 3 * len(symbol):  # finished sequences leave the arrays
            keep = np.repeat(live, sizes)
            symbol, pair, stop, owner, rank = symbol[keep], pair[keep], stop[keep], owner[keep], rank[keep]
            sizes, least = sizes[live], least[live]
        sequence = np.repeat(np.arange(len(sizes)), sizes)
        at = _every_other(np.flatnonzero((rank == least[sequence]) & (rank < NEVER)))
        new = m.made[pair[at]]
        # the pairs that each merge makes, all before it done: none may go before the next place
        has_left = np.append(False, ~stop)[at]
        before = symbol[at - 1]
        joined = np.append(False, at[1:] - at[:-1] == 2) & has_left
        before[joined] = new[np.flatnonzero(joined) - 1]
        low = np.minimum(
            np.where(has_left, m.ranks[_pairs(m, before, new)], NEVER),
            np.where(stop[at + 1], NEVER, m.ranks[_pairs(m, new, symbol[np.minimum(at + 2, len(symbol) - 1)])]))
        done = _upto_first(low <= rank[at], sequence[at])
        at, new = at[done], new[done]
        left -= np.bincount(owner[at], minlength=len(left))
        symbol[at], stop[at] = new, stop[at + 1]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        place = at - np.arange(len(at))
        symbol, stop, owner, pair = symbol[keep], stop[keep], owner[keep], pair[keep]
        # the pairs beside the merged symbols
        for i in (place[place > 0] - 1, place):
            pair[i] = -1
            i = i[~stop[i]]
            pair[i] = _pairs(m, symbol[i], symbol[i + 1])


def count_tokens(texts: pa.Array, m: Merges) -> np.ndarray:
    """The number of tokens of each text."""
    texts = pc.replace_substring(pc.fill_null(texts, ""), pattern=MARK, replacement=" ")
    data, offsets = flat_bytes(texts)
    if not len(data):
        return np.zeros(len(texts), np.int64)
    # a word begins at a text's first byte and where a run of spaces begins
    first = np.zeros(len(data), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    begins = first.copy()
    if not m.whole:
        begins[1:] |= (data[1:] == 32) & (data[:-1] != 32)
    start = np.flatnonzero(begins)
    owner = np.searchsorted(offsets, start, side="right") - 1
    words = pa.Array.from_buffers(pa.binary(), len(start), [
        None, pa.py_buffer(np.append(start, len(data)).astype(np.int32)), pa.py_buffer(data)])
    if m.dummy_prefix:
        heads = first[start]
        words = pa.concat_arrays([words.filter(pa.array(~heads)), pc.binary_join_element_wise(
            pa.scalar(b" "), words.filter(pa.array(heads)), pa.scalar(b""))])
        owner = np.concatenate([owner[~heads], owner[heads]])
    coded = words.dictionary_encode()
    n = surviving(coded.dictionary, m)[coded.indices.to_numpy()]
    return np.bincount(owner, n, len(texts)).astype(np.int64)


def _counter(merges) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merges.value
        for batch in slices(batches, "__llm_text", SLICE_BYTES):
            names = [n for n in batch.schema.names if n != "__llm_text"]
            n = count_tokens(batch.column("__llm_text"), m)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(n)],
                                             names=[*names, "__llm_tokens"])

    return count


def token_counts(spark: SparkSession, docs: DataFrame, model: bytes, *keep: Column, text: str = "text",
                 limit: int = 4096) -> DataFrame:
    """The columns ``keep`` with ``n_bytes``, ``n_tokens`` and ``over_limit``. One pass, no shuffle."""
    merges = spark.sparkContext.broadcast(read_merges(model))
    whole = F.col(f"`{text}`").cast("string")
    kept = docs.select(*keep).schema
    rows = docs.select(*keep, whole.alias("__llm_text"),
                       F.coalesce(F.octet_length(whole), F.lit(0)).cast("long").alias("__llm_bytes"))
    rows = rows.toDF(*[f"c{i}" for i in range(len(kept))], "__llm_text", "__llm_bytes")
    types = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept)]
    done = rows.mapInArrow(_counter(merges), ", ".join([*types, "__llm_bytes long", "__llm_tokens long"]))
    return done.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)],
                       F.col("__llm_bytes").alias("n_bytes"), F.col("__llm_tokens").alias("n_tokens"),
                       (F.col("__llm_tokens") > limit).alias("over_limit"))
