"""Near-duplicate classes: improved consistent weighted sampling, banded, verified.

Method. A text's features are its 5-word shingles (lower case; a text of 1 to 4
words is one shingle) with TF-IDF weights. Improved consistent weighted
sampling draws ``BANDS * ROWS`` samples, each equal for two texts with the
probability of their weighted Jaccard similarity; ``ROWS`` samples make the key
of a band, and texts that share a key are candidates. A candidate pair is
linked if its exact weighted Jaccard similarity, or the plain one of its
shingle sets, is 0.8 or more; classes are the connected components.

The plain similarity has samples and bands of its own: in a large group of near
copies the shared shingles are common, so the weights favour the few words that
differ, and a pair of plain similarity 0.8 may agree in half of the weighted
samples only. As many plain samples (least hashes) make as many plain bands; a
pair is a candidate if it agrees enough in either kind.

Document frequencies are summed in ``FREQ_CELLS`` hashed cells over all
documents. A cell is used only if over ``MIN_SHARE`` of the documents fall in
it, so the weights are one fixed-size table at every corpus size.

No pair list of a bucket is made. Texts with the same words are one node. In
each round every bucket that still holds several classes names one member, and
a text is compared with the first of those that its buckets name from other
classes. When a round finds few
links, the buckets that still hold several classes are compared whole: dealt
out by pairs of bands, or by one band where that compares no more pairs (a large group of near copies meets
under most pairs of bands), in blocks inside a task. Of all these pairs, those that
agree in too few samples for the threshold are passed over. One link is enough
to join two classes, so in the first round each text of a block names only the two
partners that agree most, and these pairs are verified: a block names at most twice as many pairs as it has
texts. While pairs of classes that are still apart have not had their turn, the
next round goes on along each text's list, up to ``MORE`` times as far, until
every such pair is verified or its classes are joined. Pairs travel as a list for each text, not as a row each.
Texts are told apart by a 64-bit hash of their words.

Defined cases: a text that is null or has no word is a class of its own;
repeated rows and texts with the same words share a class; an empty table gives
an empty result; further columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import FILE, KEYS, ROW, SLICE_BYTES, SPACE, flat_bytes, keyed, lists, ranks, scanned, slices, staged, without
from strata.llm.components import components
from strata.sinks.staging import stage_observed

WORDS = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 3
#: Kinds of samples and bands: weighted, then plain. Each has ``BANDS`` bands.
KINDS = 2
#: Shares of pairs at the threshold that may agree in fewer bands, and in fewer
#: samples, of the kind in which they are similar than ``least`` asks for.
LOST_BANDS, LOST_SAMPLES = 0.0005, 0.0015
#: Buckets of up to so many texts are one block, larger ones n are dealt into sqrt(n / BLOCK) parts, two to a block; a
#: task compares BLOCK * BLOCK pairs at once.
BLOCK = 1024
#: How many times as far each round of the blocks goes along a text's list of partners.
MORE = 16
#: Buckets of so many texts are compared many at a time, ``SMALL_ROWS`` of them at once.
SMALL, SMALL_ROWS = 24, 1000
#: A round that links less than this share of the candidate texts is the last before the blocks.
FEW_LINKS = 0.02
FREQ_CELLS = 1 << 18
MIN_SHARE = 0.01
#: Shingles x samples that are in memory at once.
CHUNK = 1024
#: Bytes of a word up to which its hash is a sum.
LONG_WORD = 1000
#: Texts, and bytes of text, of a block of nodes in which pairs are verified.
CELL, CELL_BYTES = 512, 4_000_000
#: Shingles of partners that a text is compared with at once.
PARTNERS = 1_000_000

_U = np.uint64
_SEEDS = np.random.default_rng(20240131).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | _U(1)
_PLAIN_SEEDS = np.random.default_rng(20240202).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | _U(1)
_BYTES = np.random.default_rng(20240203).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWER = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_POWER), -1, 1 << 64))
_ODD = np.random.default_rng(20240201).integers(1, 2**63, WORDS, dtype=np.uint64) | _U(1)


def least(threshold: float) -> tuple[int, int]:
    """Bands (1 or 2) and samples of one kind in which a similar pair agrees at least.

    At 0.8: 2 of 16 bands but for 2 of 10,000 pairs, 30 of 48 samples but for 14.
    """
    def most(n: int, p: float, lost: float) -> int:
        under = np.cumsum([comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)])
        return int((under <= lost).sum())

    return (min(2, max(1, most(BANDS, threshold**ROWS, LOST_BANDS))),
            most(BANDS * ROWS, threshold, LOST_SAMPLES))


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply), in place."""
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def _normal(texts: pa.Array) -> pa.Array:
    one = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=SPACE + "+",
                                     replacement=" ")
    return pc.utf8_trim(one, characters=" ")


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' fixed random values, times a power of their place in the word, summed.

    All words at once, by running sums. Equal words have equal hashes wherever
    they stand; words of over ``LONG_WORD`` bytes, where such sums could be made to meet, are
    hashed one by one.
    """
    data, offsets = flat_bytes(words)
    power = np.cumprod(np.full(len(data) + 1, _POWER))
    back = np.cumprod(np.full(len(data) + 1, _BACK))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * power[:-1], out=sums[1:])
    start, stop = offsets[:-1], offsets[1:]
    out = _mix((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64) * _POWER)
    for i in np.flatnonzero(stop - start > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(words[i].as_py())
    return out


def _shingles(normal: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, text number (ascending), count in the text."""
    n = len(normal)
    parts = pc.split_pattern(normal, pattern=" ")
    owner, flat = pc.list_parent_indices(parts), pc.list_flatten(parts)
    keep = pc.not_equal(flat, "")
    flat, owner = flat.filter(keep), owner.filter(keep).to_numpy(zero_copy_only=False).astype(np.int64)
    word = _word_hashes(flat)
    size = np.bincount(owner, minlength=n)
    short = np.flatnonzero((size > 0) & (size < WORDS))
    start = np.flatnonzero(owner[: len(owner) - WORDS + 1] == owner[WORDS - 1:]) if len(owner) >= WORDS else np.zeros(0, np.int64)
    value = np.zeros(len(start), dtype=np.uint64)
    for k in range(WORDS):
        value += _mix(word[start + k] * _ODD[k])
    whole = np.array([xxhash.xxh64_intdigest(normal[int(i)].as_py(), seed=1) for i in short], dtype=np.uint64)
    value, of = np.concatenate([_mix(value), whole]), np.concatenate([owner[start], short])
    pair, found = ranks((value ^ _mix(of.astype(np.uint64) + _U(1))).view(np.int64))
    first = np.zeros(found, dtype=np.int64)
    first[pair[::-1]] = np.arange(len(pair))[::-1]
    count = np.bincount(pair, minlength=found)
    order = np.argsort(of[first], kind="stable")
    return value[first][order], of[first][order], count[order]


def _cell(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> _U(46)).astype(np.int64)  # 18 bits: FREQ_CELLS


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, docs = np.zeros(FREQ_CELLS, dtype=np.int64), 0
    for batch in slices(batches, "text"):
        shingle, owner, _ = _shingles(_normal(batch.column("text")))
        cells += np.bincount(_cell(shingle), minlength=FREQ_CELLS)
        docs += len(np.unique(owner))
    held = np.flatnonzero(cells)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(held, -1)), pa.array(np.append(cells[held], docs))], names=["cell", "docs"])


def shingle_weights(spark: SparkSession, texts: DataFrame) -> np.ndarray:
    """IDF of each hashed cell, ln(1 + documents / holders); all documents count.

    Cells that ``MIN_SHARE`` of the documents or fewer fall in have the weight
    of that share.

    At most ``FREQ_CELLS`` rows reach the driver, however large the corpus is.
    """
    cells = staged(spark, texts.select("text").mapInArrow(_frequencies, "cell long, docs long")
                   .groupBy("cell").agg(F.sum("docs").alias("docs")), "shingle-cells")
    total = next((r.docs for r in cells.where("cell = -1").collect()), 0)
    weights = np.full(FREQ_CELLS, np.log1p(1 / MIN_SHARE), dtype=np.float32)
    common = cells.where((F.col("cell") >= 0) & (F.col("docs") > MIN_SHARE * total)).toArrow()
    share = common.column("docs").to_numpy() / max(total, 1)
    weights[common.column("cell").to_numpy()] = np.log1p(1 / np.minimum(share, 1))
    return weights


def _gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1) in 4096 cells: r; and ln c less ln(2 u) / 2, the form of its tail."""
    x = np.concatenate([np.geomspace(1e-9, 1e-2, 40_000), np.linspace(1e-2, 40, 400_000)])
    below = -np.expm1(-x) - x * np.exp(-x)
    below[x < 1e-2] = (x**2 / 2 - x**3 / 3)[x < 1e-2]
    u = (np.arange(4096) + 0.5) / 4096
    r = np.interp(u, below, x)
    return r.astype(np.float32), (np.log(r) - 0.5 * np.log(2 * u)).astype(np.float32)


_GAMMA, _TAIL = _gamma_tables()


def _samples(shingle: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Consistent weighted samples, one row for each text (0 where it has no shingle).

    For each sample and shingle r, c ~ Gamma(2, 1) and b ~ U(0, 1) come from
    the hash; t = floor(ln w / r + b); the shingle with the least
    ln c - r (t - b + 1) is drawn, together with its t.
    """
    k = BANDS * ROWS
    best = np.full((n, k), np.inf, dtype=np.float32)
    drawn = np.zeros((n, k), dtype=np.uint64)
    log_w, each = np.log(weight.astype(np.float32)), np.arange(k)
    for at in range(0, len(shingle), CHUNK):
        part = slice(at, at + CHUNK)
        own = owner[part]
        x = _SEEDS[:, None] * shingle[None, part]  # a row for each sample
        x ^= x >> _U(31)
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
        halves = x.view(np.uint32).reshape(k, len(own), 2)
        r = np.take(_GAMMA, (x & _U(4095)).view(np.int64), mode="clip")
        b = (halves[:, :, 0] >> np.uint32(12)).astype(np.float32)
        b *= np.float32(2.0**-20)
        score = halves[:, :, 1].astype(np.float32)
        score += np.float32(0.5)
        score *= np.float32(2.0**-31)
        np.log(score, out=score)
        score *= np.float32(0.5)
        score += np.take(_TAIL, (x >> _U(52)).view(np.int64), mode="clip")
        t = log_w[None, part] / r
        t += b
        np.floor(t, out=t)
        b -= t
        b -= np.float32(1)
        b *= r
        score += b  # ln c - r (t - b + 1)
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(own)], strict=True):
            place = start + score[:, start:stop].argmin(axis=1)
            least, text = score[each, place], own[start]
            better = least < best[text]
            if better.any():
                place, col = place[better], each[better]
                best[text, col] = least[better]
                drawn[text, col] = _mix(shingle[at + place] ^ (
                    t[col, place].astype(np.int64).view(np.uint64) * _U(0x9E3779B97F4A7C15)))
    return drawn


def _plain_samples(shingle: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The least hashes of each text's shingles, one row for each text (all ones where it has none)."""
    drawn = np.full((n, BANDS * ROWS), ~_U(0))
    for at in range(0, len(shingle), CHUNK):
        own = owner[at: at + CHUNK]
        x = _PLAIN_SEEDS[:, None] * shingle[None, at: at + CHUNK]
        x ^= x >> _U(31)
        x *= _U(0xD6E8FEB86659FD93)
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        text = own[starts]
        drawn[text] = np.minimum(drawn[text], np.minimum.reduceat(x, starts, axis=1).T)
    return _mix(drawn)


def _sketch(weights: np.ndarray) -> Callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n = batch.num_rows
            normal = _normal(batch.column("text"))
            shingle, owner, count = _shingles(normal)
            drawn = np.hstack([_samples(shingle, count * weights[_cell(shingle)], owner, n),
                               _plain_samples(shingle, owner, n)])
            band = np.arange(KINDS * BANDS, dtype=np.uint64)[None, :] * _U(0x9E3779B97F4A7C15)
            key = np.tile(band, (n, 1))
            for row in range(ROWS):
                key = _mix(key + drawn[:, row::ROWS])
            print_ = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(KINDS * BANDS * ROWS), n, [None, pa.py_buffer((drawn >> _U(56)).astype(np.uint8).tobytes())])
            none = np.bincount(owner, minlength=n) == 0
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * KINDS * BANDS, pa.int32()), pa.array(key.view(np.int64).ravel()),
                mask=pa.array(none))
            content = np.array([xxhash.xxh3_64_intdigest(x) for x in normal.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(FILE), batch.column(ROW), batch.column("doc_id"),
                 pa.array(content), bands, print_.cast(pa.binary())],
                names=[FILE, ROW, "doc_id", "content", "bands", "samples"])

    return sketch


def _similar(weights: np.ndarray, threshold: float) -> Callable:
    """The similar ones of batches of pairs ``a, b`` whose texts, ``text_a`` and ``text_b``, share one dictionary.

    Each text is cut into shingles once; then the weights of a text's shingles
    are laid out by shingle, and all its partners' shingles are looked up in them.
    """
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("text_a"), batch.column("text_b")
            texts = pa.RecordBatch.from_arrays([left.dictionary], names=["text"])
            one, two = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (left, right))
            shingle, owner, count, done = [], [], [], 0
            for part in slices([texts], "text"):
                found = _shingles(_normal(part.column("text")))
                shingle.append(found[0])
                owner.append(found[1] + done)
                count.append(found[2])
                done += part.num_rows
            shingle = np.concatenate(shingle)
            code, distinct = ranks(shingle.view(np.int64))
            weight = np.concatenate(count) * weights[_cell(shingle)].astype(np.float64)
            size = np.bincount(np.concatenate(owner), minlength=done)
            begin = np.cumsum(size) - size
            whole = np.bincount(np.concatenate(owner), weight, done)
            laid, score = np.zeros(distinct), np.zeros(len(one))
            order = np.argsort(one, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(one[order])) + 1) if len(order) else ():
                text = one[run[0]]
                own = slice(begin[text], begin[text] + size[text])
                laid[code[own]] = weight[own]
                held = np.cumsum(size[two[run]])
                for places in np.split(run, np.flatnonzero(np.diff(held // PARTNERS)) + 1):
                    other = two[places]
                    n = size[other]
                    starts = np.cumsum(n) - n
                    at = np.repeat(begin[other] - starts, n) + np.arange(n.sum())
                    mine, of = laid[code[at]], np.repeat(np.arange(len(other)), n)
                    least_weight = np.bincount(of, np.minimum(mine, weight[at]), len(other))
                    both = np.bincount(of[mine > 0], minlength=len(other))
                    score[places] = np.maximum(
                        least_weight / np.maximum(whole[text] + whole[other] - least_weight, 1e-9),
                        both / np.maximum(size[text] + n - both, 1))
                laid[code[own]] = 0
            keep = pa.array(score >= threshold - 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return similar


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows that hold whole cells, of ``SLICE_BYTES`` of text or one cell; rows come in the order of ``cell``."""
    held, last, size = [], None, 0
    for batch in batches:
        cell = batch.column("cell").to_numpy()
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        starts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()] if len(cell) else []
        for start, stop in zip(starts, [*starts[1:], len(cell)], strict=False):
            if held and size >= SLICE_BYTES and cell[start] != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            held.append(batch.slice(start, stop - start))
            last, size = cell[start], size + int(ends[stop - 1] - (ends[start - 1] if start else 0))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _in_cells(check: Callable) -> Callable:
    """``check`` on the pairs of whole cells; a row is a node of a cell with its text and its ``partners`` there."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            node, partners = rows.column("node").to_numpy(), rows.column("partners").combine_chunks()
            one, other = pc.list_parent_indices(partners).to_numpy(), pc.list_flatten(partners).to_numpy(zero_copy_only=False)
            cell, _ = ranks(rows.column("cell").to_numpy())
            code, distinct = ranks(np.concatenate([node, other]))
            key = cell * distinct + code[: len(node)]
            order = np.argsort(key)
            two = order[np.searchsorted(key[order], cell[one] * distinct + code[len(node):])]
            texts = rows.column("text").combine_chunks()
            text = lambda place: pa.DictionaryArray.from_arrays(pa.array(place, pa.int32()), texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[one]), pa.array(other), text(one), text(two)], names=["a", "b", "text_a", "text_b"])

    return lambda batches: check(pairs(batches))


def _turns(own: np.ndarray, other: np.ndarray, same: np.ndarray, node: np.ndarray, now: np.ndarray, start: int,
           stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs ``(own, other)``: those named now, and the places of nodes with pairs for later.

    ``own`` and ``other`` are places in ``node``, a pair's agreement is ``same``. A node's list has
    its pairs that agree most first. Turns do not depend on the links found since; a pair is named in its
    turn unless its classes have become one (``now``).
    """
    rank = np.empty(len(node), np.int64)
    rank[np.argsort(node, kind="stable")] = np.arange(len(node))
    order = np.argsort((own * 64 + (BANDS * ROWS - same)) * len(node) + rank[other])
    own, other = own[order], other[order]
    number = np.arange(len(own))
    new = np.append(True, own[1:] != own[:-1])[: len(own)]
    turn = number - np.maximum.accumulate(np.where(new, number, 0)) if len(own) else number
    apart = now[own] != now[other]
    named = apart & (turn >= start) & (turn < stop)
    return own[named], other[named], own[apart & (turn >= stop)]


def _owned(i: np.ndarray, j: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs as (the node in whose list a pair is, the other)."""
    left = _listed_by(node[i], node[j])
    return np.where(left, i, j), np.where(left, j, i)


def _listed_by(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether a pair of nodes is in the list of the first; of two nodes just one lists it."""
    return (((one ^ other) & 1 == 0) == (one < other)) & (one != other)


def _named_rows(a: np.ndarray, b: np.ndarray, pair: np.ndarray, x: np.ndarray, y: np.ndarray, more: list) -> pa.Table:
    """The named pairs with their block's key, then a row without a pair for each block in ``more``."""
    none = [None] * len(more)
    both = lambda v, k, t: pa.array([*v.tolist(), *[m[k] for m in more]], t)
    return pa.table({
        "a": pa.array([*np.minimum(a, b).tolist(), *none], pa.int64()),
        "b": pa.array([*np.maximum(a, b).tolist(), *none], pa.int64()),
        "pair": both(pair, 0, pa.int64()), "x": both(x, 1, pa.int32()), "y": both(y, 2, pa.int32())})


def _listed(named: pa.Table) -> pa.Table:
    """Named pairs as a row for each node: its ``partners`` with a greater number, and those with a smaller one (``met``).

    The rows that say which blocks have more stay as they are.
    """
    one = named.filter(pc.is_valid(named.column("a")))
    more = named.filter(pc.is_null(named.column("a")))
    a, b = (one.column(c).to_numpy() for c in ("a", "b"))
    node, side = np.concatenate([a, b]), np.concatenate([b, a])
    code, n = ranks(node)
    order = np.argsort(code, kind="stable")
    code, side, own = code[order], side[order], order < len(a)
    first = np.zeros(n, np.int64)
    first[code] = node[order]
    none = pa.nulls(more.num_rows, pa.list_(pa.int64()))
    ends = lambda k: pa.chunked_array([lists(pa.array(side[k], pa.int64()), code[k], n), none])
    block = lambda c: pa.chunked_array([pa.nulls(n, named.schema.field(c).type), *more.column(c).chunks])
    return pa.table({
        "node": pa.chunked_array([pa.array(first, pa.int64()), pa.nulls(more.num_rows, pa.int64())]),
        "partners": ends(own), "met": ends(~own), "pair": block("pair"), "x": block("x"), "y": block("y")}).combine_chunks()


def _agreeing(least_samples: int, start: int = 0, stop: int = 1, least_bands: int = 1) -> Callable:
    """Of a block: for each node the partners ``start`` to ``stop`` of its list that are still apart.

    Equal ``low`` and ``high`` make it a bucket of one band, whose pairs agree in no band before and in
    ``least_bands`` (1 or 2) in all.

    A pair agrees in enough samples and was of two classes when the blocks
    began (``label``); it is in the list of one of its nodes (``_turns``). If
    a pair apart comes after ``stop``, a last row without ``a`` and ``b``
    says so; each row has the block's key.
    """
    def agreeing(key: tuple, block: pa.Table) -> pa.Table:
        node, label, now, second = (np.array(block.column(c)) for c in ("node", "label", "now", "second"))
        key = [getattr(k, "as_py", lambda k=k: k)() for k in key]
        low_band, high_band = (block.column(c)[0].as_py() % BANDS for c in ("low", "high"))
        samples = np.frombuffer(b"".join(block.column("samples").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS).T.copy()
        keys = block.column("keys").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        one, two = np.flatnonzero(~second), np.flatnonzero(second)
        bands = [low_band, high_band, *[b for b in range(high_band) if b != low_band]]
        found = []
        # the pairs in the lists of some nodes at once, all their partners beside them
        for mine, rest in ((one, two), (two, one)) if len(two) or key[1] != key[2] else ((one, one),):
            width = max(1, BLOCK * BLOCK // max(1, len(rest)))
            for mine in np.split(mine, range(width, len(mine), width)):
                near = label[mine][:, None] != label[rest][None, :]
                near &= _listed_by(node[mine][:, None], node[rest][None, :])
                # a pair meets under each two of its bands; the first two name it
                for band in bands:
                    if (now == now[0]).all() or not near.any():
                        near[:] = False
                        break
                    equal = keys[mine, band][:, None] == keys[rest, band][None, :]
                    near &= equal if band in (low_band, high_band) else ~equal
                held, by = near.any(axis=1), near.any(axis=0)
                mine, other, near = mine[held], rest[by], near[held][:, by]
                if low_band == high_band and least_bands > 1 and near.size:
                    again = np.zeros(near.shape, bool)
                    for band in range(low_band + 1, BANDS):
                        again |= keys[mine, band][:, None] == keys[other, band][None, :]
                    near &= again
                agreed = np.zeros(near.shape, np.uint8)
                for column in samples if near.size else ():
                    agreed += column[mine][:, None] == column[other][None, :]
                i, j = np.nonzero(near & (agreed >= least_samples))
                found.append(_turns(mine[i], other[j], agreed[i, j].astype(np.int64), node, now, start, stop))
        own, other, later = (np.concatenate([f[k] for f in found]) for k in range(3))
        of = lambda k: np.full(len(own), key[k])
        return _named_rows(node[own], node[other], of(0), of(1), of(2), [key] if len(later) else [])

    return agreeing


def _agreeing_small(least_samples: int, start: int, stop: int, least_bands: int = 1) -> Callable:
    """``_agreeing`` for buckets of ``SMALL`` nodes at most, many at a time: a row is a bucket."""
    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SMALL_ROWS):
                batch = whole.slice(at, SMALL_ROWS)
                held = batch.column("held")
                size, rows = pc.list_value_length(held).to_numpy(zero_copy_only=False).astype(np.int64), held.flatten()
                node, label, now = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("node", "label", "now"))
                keys = rows.field("keys").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
                samples = np.frombuffer(b"".join(rows.field("samples").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
                begin, i, j = np.cumsum(size) - size, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for n in np.unique(size):
                    left, right = np.triu_indices(n, 1)
                    places = begin[size == n][:, None]
                    i.append((places + left).ravel())
                    j.append((places + right).ravel())
                i, j = np.concatenate(i), np.concatenate(j)
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]
                of = np.repeat(np.arange(len(size)), size)
                low, high = (np.array(batch.column(c))[of] % BANDS for c in ("low", "high"))
                equal = keys[i] == keys[j]
                each = np.arange(len(i))
                first = equal[each, low[i]] & equal[each, high[i]] & (
                    (equal & (np.arange(BANDS) < high[i][:, None])).sum(axis=1) == (low[i] < high[i])) & (
                    equal.sum(axis=1) >= least_bands)
                i, j = i[first], j[first]
                same = (samples[i] == samples[j]).sum(axis=1)
                near = same >= least_samples
                own, other, later = _turns(*_owned(i[near], j[near], node), same[near], node, now, start, stop)
                pair, none = np.array(batch.column("pair")), np.zeros(len(own), np.int64)
                more = [(p, 0, 0) for p in pair[np.unique(of[later])].tolist()]
                yield from _named_rows(node[own], node[other], pair[of[own]], none, none, more).to_batches()

    return agreeing


def _in_lists(agreeing: Callable, agreeing_small: Callable) -> tuple[Callable, Callable]:
    """Both forms with lists of pairs (``_listed``) in place of pairs."""
    def block(key: tuple, rows: pa.Table) -> pa.Table:
        return _listed(agreeing(key, rows))

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in agreeing_small(batches):
            yield from _listed(pa.Table.from_batches([batch])).to_batches()

    return block, many


def _alike(least_samples: int) -> Callable:
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, KINDS, BANDS * ROWS)
                        for c in ("samples_node", "samples_lead"))
            a, b = (np.array(batch.column(c)) for c in ("node", "lead"))
            keep = ((one == two).sum(axis=2) >= least_samples).any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep], pa.int64()),
                                              pa.array(np.maximum(a, b)[keep], pa.int64())], names=["a", "b"])

    return alike


def _agree(pairs: DataFrame, nodes: DataFrame, least_samples: int) -> DataFrame:
    """The pairs ``(node, lead)`` that agree in enough samples, each once as ``(a, b)``."""
    side = lambda c: nodes.select(F.col("content").alias(c), F.col("samples").alias(f"samples_{c}"))
    return (pairs.join(side("node"), "node").join(side("lead"), "lead")
            .select("node", "lead", "samples_node", "samples_lead")
            .mapInArrow(_alike(least_samples), "a long, b long").distinct())


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, check: Callable, blocks: int) -> tuple[DataFrame, int]:
    """Staged links among the distinct pairs ``(a, b)``; and how many there are.

    The nodes are dealt into ``blocks``, and a cell is two of them. A text goes
    once to each cell in which it has a pair, not once to each of its pairs: to ``blocks``
    cells at most, which hold two blocks of texts each.
    """
    pairs = staged(spark, pairs, "pairs")
    x, y = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in ("a", "b"))
    pairs = pairs.select((F.least(x, y) * blocks + F.greatest(x, y)).alias("cell"), "a", "b")
    ends = pairs.select("cell", F.col("a").alias("node"), F.col("b").alias("partner")).unionByName(
        pairs.select("cell", F.col("b").alias("node"), F.lit(None).cast("long").alias("partner")))
    rows = ends.groupBy("cell", "node").agg(F.collect_list("partner").alias("partners"))  # the nodes of a cell at most
    return _checked(spark, rows, texts, check)


def _dealt_cells(blocks: int) -> Callable:
    """``_verified``'s cells of nodes with lists of their pairs: ``cell, node, partners``, each pair once."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, part = (batch.column(c).to_numpy() for c in ("node", "part"))
            row, partner, other = [], [], []
            for c in ("partners", "met"):
                held = batch.column(c)
                row.append(pc.list_parent_indices(held).to_numpy().astype(np.int64))
                partner.append(held.flatten().to_numpy())
                other.append(batch.column(f"{c}_part").flatten().to_numpy())
            own = np.repeat([True, False], [len(r) for r in row])
            row, partner, other = (np.concatenate(x) for x in (row, partner, other))
            cell = np.minimum(part[row], other) * blocks + np.maximum(part[row], other)
            order = np.lexsort((partner, cell, row))
            row, partner, cell, own = row[order], partner[order], cell[order], own[order]
            new = np.append(True, (row[1:] != row[:-1]) | (cell[1:] != cell[:-1]))[: len(row)]
            again = np.append(False, partner[1:] == partner[:-1])[: len(row)] & ~new
            group, own = np.cumsum(new) - 1, own & ~again
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[new], pa.int64()), pa.array(node[row[new]], pa.int64()),
                 lists(pa.array(partner[own], pa.int64()), group[own], int(new.sum()))], names=["cell", "node", "partners"])

    return dealt


def _cells(texts: int, size: int) -> int:
    """Blocks of ``CELL`` texts and ``CELL_BYTES`` bytes for so many."""
    return max(1, -(-texts // CELL), -(-size // CELL_BYTES))


def _verified_lists(spark: SparkSession, named: DataFrame, texts: DataFrame, check: Callable) -> tuple[DataFrame, int]:
    """``_verified`` of pairs that come as lists (``_listed``), in blocks of the nodes that have a pair."""
    ends = named.where("node IS NOT NULL").groupBy("node").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("partners", "met")])
    ends, seen = stage_observed(spark, ends.join(texts.select("node", "bytes"), "node"), "lists", {
        "n": F.count(F.lit(1)), "bytes": F.coalesce(F.sum("bytes"), F.lit(0))})
    blocks = _cells(seen["n"], seen["bytes"])
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    rows = ends.select("node", part("node").alias("part"), "partners", "met",
                       *[F.transform(c, part).alias(f"{c}_part") for c in ("partners", "met")])
    rows = staged(spark, rows.mapInArrow(_dealt_cells(blocks), "cell long, node long, partners array<long>"), "cells")
    return _checked(spark, rows, texts, check)


def _checked(spark: SparkSession, rows: DataFrame, texts: DataFrame, check: Callable) -> tuple[DataFrame, int]:
    """Staged links of the cells' rows ``cell, node, partners``; and how many there are."""
    # sort-merge at every size: the texts of a large corpus are not for broadcasting
    found = (rows.hint("merge").join(texts.select("node", "text"), "node").repartition("cell").sortWithinPartitions("cell")
             .select("cell", "node", "text", "partners").mapInArrow(_in_cells(check), "a long, b long"))
    links, seen = stage_observed(spark, found, "links", {"n": F.count(F.lit(1))})
    return links, seen["n"]


def _joined(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after the links: classes that are linked become one."""
    old = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    between = links.join(old, "a").join(
        old.select(F.col("a").alias("b"), F.col("la").alias("lb")), "b")
    merged = components(spark, between.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    return staged(spark, labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("to")),
                                     "label", "left")
                  .select("node", F.coalesce("to", "label").alias("label")), "classes")


def _settled(spark: SparkSession, labels: DataFrame, members: DataFrame, nodes: DataFrame, texts: DataFrame,
             check: Callable, least_bands: int, least_samples: int) -> DataFrame:
    """Labels after the blocks: the buckets that still hold several classes are compared whole.

    Each round takes the blocks that held back pairs in the last one. A block's
    rows and lists are the same in each round, ``now`` are the classes so far.
    """
    began = labels
    held = members.join(labels, "node")
    mixed = staged(spark, held.groupBy("key").agg(
        F.min("label").alias("l1"), F.max("label").alias("l2"), F.count(F.lit(1)).alias("n"))
        .where("l1 != l2").select("key", "n"), "mixed")
    later = f"y.band > x.band AND y.band div {BANDS} = x.band div {BANDS}" if least_bands > 1 else "y.band = x.band"
    two = (held.join(mixed, "key", "left_semi").groupBy("node", "label")
           .agg(F.collect_set(F.struct("band", "key")).alias("keys"))  # KINDS * BANDS at most
           .select("node", "label", F.explode(F.expr(
               f"flatten(transform(keys, x -> transform(filter(keys, y -> {later}), "
               "y -> struct(x.band AS low, y.band AS high, x.key AS key, xxhash64(x.key, y.key) AS pair))))"
           )).alias("p")).select("node", "label", "p.low", "p.high", "p.key", "p.pair"))
    two = staged(spark, two, "band-pairs")
    size = staged(spark, two.groupBy("pair").agg(
        F.count(F.lit(1)).alias("size"), F.min("label").alias("l1"), F.max("label").alias("l2"), F.first("key").alias("key"))
        .where("l1 != l2").select("pair", "key", "size"), "band-pairs")
    # the first band of a pair is a bucket too: it takes all these pairs if it compares no more of them than theirs do
    whole = staged(spark, size.groupBy("key").agg(F.sum(F.col("size") * F.col("size")).alias("compared"))
                   .join(mixed, "key").where("n * n <= compared").select("key", F.col("n").alias("size")), "one-band")
    cut_up = size.join(whole.select("key"), "key", "left_anti").select("pair", "size")
    one = held.join(whole, "key").select(F.col("key").alias("pair"), F.col("band").alias("low"), F.col("band").alias("high"),
                                         "node", "size")
    blocks = F.ceil(F.sqrt(F.col("size") / BLOCK)).cast("int")
    dealt = (two.join(cut_up, "pair").select("pair", "low", "high", "node", "size").unionByName(one)
             .withColumn("block", F.pmod(F.xxhash64("node"), blocks))
             .select("pair", "low", "high", "node", "size", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
             .select("pair", "low", "high", "node", "size", F.least("block", "other").cast("int").alias("x"),
                     F.greatest("block", "other").cast("int").alias("y"), (F.col("block") > F.col("other")).alias("second")))
    dealt = staged(spark, dealt, "dealt")
    start, stop, cut = 0, 2, None
    while True:
        side = nodes.select(F.col("content").alias("node"), F.col("samples").alias("all"), "bands").join(began, "node").join(
            labels.withColumnRenamed("label", "now"), "node")

        def rows(sizes: str, cut: DataFrame | None = cut, side: DataFrame = side) -> DataFrame:
            now = dealt.where(sizes)
            now = now if cut is None else now.join(cut, ["pair", "x", "y"], "left_semi")
            return now.join(side, "node").select(
                "pair", "x", "y", "low", "high", "second", "node", "label", "now",
                F.expr(f"slice(bands, cast({BANDS} * (low div {BANDS}) + 1 as int), {BANDS})").alias("keys"),
                F.expr(f"substring(all, cast({BANDS * ROWS} * (low div {BANDS}) + 1 as int), {BANDS * ROWS})").alias("samples"))

        shape = "node long, partners array<long>, met array<long>, pair long, x int, y int"
        block, many = _in_lists(_agreeing(least_samples, start, stop, least_bands),
                                _agreeing_small(least_samples, start, stop, least_bands))
        large = rows(f"size > {SMALL}").groupBy("pair", "x", "y").applyInArrow(block, shape)
        small = (rows(f"size <= {SMALL}").groupBy("pair").agg(
            F.min("low").alias("low"), F.min("high").alias("high"),
            F.collect_list(F.struct("node", "label", "now", "keys", "samples")).alias("held"))  # SMALL at most
            .where(F.size(F.array_distinct("held.now")) > 1)
            .mapInArrow(many, shape))
        named, seen = stage_observed(spark, large.unionByName(small), "named", {"cut": F.count_if(F.col("node").isNull())})
        links, n = _verified_lists(spark, named, texts, check)
        if n:
            labels = _joined(spark, labels, links)
        if not seen["cut"]:
            return labels
        start, stop, cut = stop, stop * MORE, named.where("node IS NULL").select("pair", "x", "y")


def near_classes(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD, scan: bool = False) -> DataFrame:
    """A row for each document, keyed by row: ``doc_id, class_id, class_size, kept``.

    ``class_id`` is the id of the document that stays, the smallest of its
    class (null last, then the first place in the input files).
    """
    docs = scanned(spark, docs, scan)
    rows = keyed(spark, docs, F.col(f"`{doc_id}`").alias("doc_id"),
                 F.col(f"`{text}`").cast("string").alias("text"), scan=True)
    weights = shingle_weights(spark, rows)
    kind = docs.schema[doc_id].dataType.simpleString()
    sketches = staged(spark, rows.mapInArrow(
        _sketch(weights), f"{FILE} long, {ROW} long, doc_id {kind}, content long, bands array<long>, samples binary"), "sketches")
    nodes = staged(spark, sketches.where("bands IS NOT NULL").groupBy("content").agg(
        F.first("bands").alias("bands"), F.first("samples").alias("samples"), F.min(F.struct(*KEYS)).alias("at"))
        .select("content", "bands", "samples", F.col(f"at.{FILE}").alias(FILE), F.col(f"at.{ROW}").alias(ROW)), "nodes")
    keys = nodes.select(F.col("content").alias("node"), F.posexplode("bands").alias("band", "key"))
    shared = staged(spark, keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "buckets")
    # a similar pair shares so many buckets of one kind, so a text in fewer has no partner
    least_bands, least_samples = least(threshold)
    enough = F.greatest(*[F.count_if(F.floor(F.col("band") / BANDS) == k) for k in range(KINDS)]) >= least_bands
    inside = staged(spark, keys.join(shared, "key"), "members")
    labels = staged(spark, inside.groupBy("node").agg(enough.alias("enough"))
                    .where("enough").select("node", F.col("node").alias("label")), "classes")
    members = staged(spark, inside.join(labels.select("node"), "node"), "members")
    reps = staged(spark, nodes.join(labels, F.col("content") == F.col("node")).select("node", *KEYS), "members")
    texts, held = stage_observed(spark, rows.join(reps.hint("merge"), list(KEYS)).select(
        "node", "text", F.octet_length("text").alias("bytes")), "texts", {
        "n": F.count(F.lit(1)), "bytes": F.coalesce(F.sum("bytes"), F.lit(0))})
    turn, total = 0, held["n"]
    cells = _cells(total, held["bytes"])
    check = _similar(weights, threshold)
    while True:
        held = members.join(labels, "node")
        mixed = held.groupBy("key").agg(
            F.min("label").alias("l1"), F.max("label").alias("l2"),
            F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "label")).alias("lead"))
        mixed = staged(spark, mixed.where("l1 != l2").select(
            "key", F.col("lead.h").alias("h"), F.col("lead.node").alias("lead"),
            F.col("lead.label").alias("lead_label")), "mixed")
        # one lead for each node and round: the first of its buckets' leads
        first = F.min(F.struct("h", "lead")).alias("first")
        pairs = _agree(held.join(mixed, "key").where("label != lead_label").groupBy("node").agg(first)
                       .select("node", F.col("first.lead").alias("lead")), nodes, least_samples)
        links, n = _verified(spark, pairs, texts, check, cells)
        if n:
            labels = _joined(spark, labels, links)
        if n <= FEW_LINKS * total:
            break
        turn += 1
    labels = _settled(spark, labels, members, nodes, texts, check, least_bands, least_samples)
    named = sketches.join(labels, F.col("content") == F.col("node"), "left").withColumn(
        "class", F.when(F.col("bands").isNotNull(), F.coalesce("label", "content")))
    # a text without words: a class of its own
    named = staged(spark, named.select(*KEYS, "doc_id", "class", *[
        F.when(F.col("class").isNull(), F.col(k)).otherwise(0).alias(f"own{k}") for k in KEYS]), "near-classes")
    group = ["class", *[f"own{k}" for k in KEYS]]
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEYS)).alias("best")
    heads = staged(spark, named.groupBy(*group).agg(best, F.count(F.lit(1)).alias("class_size")), "near-heads")
    same = [named[c].eqNullSafe(heads[c]) for c in group]
    return named.join(heads, same[0] & same[1] & same[2]).select(
        *KEYS, "doc_id", F.col("best.doc_id").alias("class_id"), "class_size",
        ((F.col(f"best.{FILE}") == F.col(FILE)) & (F.col(f"best.{ROW}") == F.col(ROW))).alias("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     threshold: float = THRESHOLD, scan: bool = False) -> DataFrame:
    """``docs`` with one document of each class; same columns."""
    docs = scanned(spark, docs, scan)
    found = near_classes(spark, docs, doc_id, text, threshold, scan=True)
    return without(spark, docs, staged(spark, found.where(~F.col("kept")).select(*KEYS), "near-copies"))
