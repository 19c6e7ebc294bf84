"""Toxicity scores: averaged subword embeddings under a linear softmax.

Method. A word is the bag of its character 3- to 5-grams, with its borders
marked, and of itself, hashed into ``CELLS`` embedding rows; a window of
``WINDOW`` words is the mean of its words' means, and a linear softmax turns it
into the probability of label 1. Embeddings and softmax are trained jointly, in
numpy, by gradient descent with momentum. A misspelt or inflected word that was
never seen shares most of its n-grams, and so its vector, with the word it
comes from.

Labels belong to whole documents, but a toxic document is mostly harmless
words. So a document scores as its highest window, and training repeats: after
a first fit on whole stretches, only the ``TOP`` highest windows of a toxic document
count as toxic and its others as unlabelled, and the highest of a harmless
document weigh ``HARD`` times.

The model is fitted on a bounded sample: about ``SAMPLE_DOCS`` labelled
documents of each label, drawn by a hash over all of them, a stretch of
``SAMPLE_WORDS`` words at a hashed place of each.

Defined cases: null and empty texts and texts without a word get the model's
score of an empty window; rows without a label are not learned from; without
both labels every text scores 0; of several labels of a document the largest
counts; repeated rows score alike; further columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices

WINDOW = 12
CELLS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5)
SAMPLE_DOCS = 1500
SAMPLE_WORDS = 480
THRESHOLD = 0.7
STEPS = (20, 15, 15, 15)
TOP, HARD = 2, 10.0
DECAY = 0.002
#: An n-gram (its cell) is learned if this many texts of the sample hold it.
MIN_TEXTS = 10
RATE = (2.0, 0.02, 0.05)
SEED = 29

NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


@dataclass(frozen=True)
class Model:
    """Each cell's share in the logit of label 1, and the softmax's offset."""

    cells: np.ndarray
    offset: float


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the code of every word in order, and its text's number."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), pattern=NOT_WORD, replacement=" ")
    parts = pc.split_pattern(plain, pattern=" ")
    owner, flat = pc.list_parent_indices(parts), pc.list_flatten(parts)
    keep = pc.not_equal(flat, "")
    coded = flat.filter(keep).dictionary_encode()
    return (coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            owner.filter(keep).to_numpy(zero_copy_only=False).astype(np.int64))


def grams(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of every n-gram of the words (ordered by word), and where each word begins."""
    marked = [f"<{w}>" for w in vocabulary.to_pylist()]
    size = np.array([len(w) for w in marked], dtype=np.int64)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), size)
    odd = np.uint64(0x9E3779B97F4A7C15)
    cells, of = [], []
    total = np.zeros(len(chars), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(GRAMS) + 1):
            if len(chars) < n:
                break
            total = total[: len(chars) - n + 1] * odd + (chars[n - 1:] + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            if n in GRAMS:
                inside = owner[: len(total)] == owner[n - 1:]
                cells.append(total[inside])
                of.append(owner[: len(total)][inside])
        # the word itself
        place = np.arange(len(chars), dtype=np.uint64) - np.repeat(np.cumsum(size) - size, size).astype(np.uint64)
        mixed = (chars + np.uint64(7)) * (odd ** (place % np.uint64(61) + np.uint64(1)))
        starts = np.cumsum(size) - size
        if len(chars):
            cells.append(np.add.reduceat(mixed, starts))
            of.append(np.arange(len(marked)))
    if not cells:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cell, word = np.concatenate(cells), np.concatenate(of)
    order = np.argsort(word, kind="stable")
    cell = cell[order]
    cell ^= cell >> np.uint64(31)
    cell = cell * np.uint64(0xD6E8FEB86659FD93)
    return (cell >> np.uint64(48)).astype(np.int64), np.searchsorted(word[order], np.arange(len(marked)))


def _windows(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each window begins, and its text. A text's last window may be shorter."""
    count = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts = np.flatnonzero(place % WINDOW == 0)
    return starts, owner[starts]


def _means(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    size = np.diff(np.append(starts, len(values)))
    shape = (-1,) + (1,) * (values.ndim - 1)
    return np.add.reduceat(values, starts, axis=0) / size.reshape(shape).astype(values.dtype)


def _spread(gradient: np.ndarray, starts: np.ndarray, to: np.ndarray, order: np.ndarray, n: int,
            mean: bool = True) -> np.ndarray:
    """Backward of sums or means over groups of ``to``: for each target, its groups' gradients."""
    size = np.diff(np.append(starts, len(to)))
    each = np.repeat(gradient / size[:, None].astype(gradient.dtype) if mean else gradient, size, axis=0)[order]
    out = np.zeros((n, gradient.shape[1]), dtype=gradient.dtype)
    hit, first = np.unique(to[order], return_index=True)
    out[hit] = np.add.reduceat(each, first, axis=0)
    return out


def fit(texts: list[str], toxic: np.ndarray, steps: tuple[int, ...] = STEPS, seed: int = SEED) -> Model:
    """The model of the documents' texts and labels (0 or 1)."""
    toxic = np.asarray(toxic).astype(bool)
    vocabulary, code, owner = words(pa.array(texts, pa.string()))
    if not len(code) or toxic.all() or not toxic.any():
        return Model(np.zeros(CELLS, np.float32), -np.inf)
    cell, cell_start = grams(vocabulary)
    # n-grams of few texts teach nothing about others; they stay zero
    held = np.unique(code * len(texts) + owner) // len(texts)
    of_word = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(cell_start, len(cell))))
    in_texts = np.bincount(cell, np.bincount(held, minlength=len(vocabulary))[of_word], CELLS)
    used = np.bincount(cell, np.bincount(code, minlength=len(vocabulary))[of_word], CELLS)
    # a cell's step: what it explains over the square root of its use, as in a test of means
    pace = ((in_texts >= min(MIN_TEXTS, len(texts) // 4)) / np.sqrt(np.maximum(used, 1))).astype(np.float32)[:, None]
    order_w, order_c = np.argsort(code, kind="stable"), np.argsort(cell, kind="stable")
    rng = np.random.default_rng(seed)
    table = (pace > 0) * rng.uniform(-1, 1, (CELLS, DIM)).astype(np.float32) / DIM
    softmax, bias = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    params = [table, softmax, bias]
    moment = [np.zeros_like(p) for p in params]

    def forward(code: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        window = np.add.reduceat(_means(table[cell], cell_start)[code], starts, axis=0) / size
        logit = window @ softmax + bias
        odds = np.exp(logit - logit.max(axis=1, keepdims=True))
        return window, odds / odds.sum(axis=1, keepdims=True)

    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    size = np.diff(np.append(starts, len(owner))).astype(np.float32)[:, None]
    text = owner[starts]
    weight, label, code_t = np.ones(len(text), dtype=np.float32), toxic[text], code
    for turn, rounds in enumerate(steps):
        if turn:
            starts, text = _windows(owner, len(texts))
            size, label = np.float32(WINDOW), toxic[text]
            p = forward(code, starts, size)[1][:, 1]
            ranked = np.lexsort((-p, text))
            first = np.searchsorted(text[ranked], text[ranked])
            place = np.empty(len(p), dtype=np.int64)
            place[ranked] = np.arange(len(p)) - first  # 0: the highest of its text
            weight = np.where(label, place < TOP, np.where(place < TOP, HARD, 1.0)).astype(np.float32)
            # windows without a weight are left out
            used_w = weight > 0
            words_in = np.diff(np.append(starts, len(owner)))
            code_t = code[np.repeat(used_w, words_in)]
            label, weight, words_in = label[used_w], weight[used_w], words_in[used_w]
            starts = np.cumsum(words_in) - words_in
            order_w = np.argsort(code_t, kind="stable")
        for side in (label, ~label):  # both labels weigh the same
            weight[side] /= max(weight[side].sum(), 1e-9) * 2
        for _ in range(rounds):
            window, p = forward(code_t, starts, size)
            error = p.copy()
            error[np.arange(len(label)), label.astype(int)] -= 1
            error *= weight[:, None]
            d_word = _spread(error @ softmax.T / size, starts, code_t, order_w, len(vocabulary), False)
            grads = [pace * _spread(d_word, cell_start, cell, order_c, CELLS), window.T @ error, error.sum(axis=0)]
            for i, g in enumerate(grads):
                # one step size for a whole matrix
                moment[i] += 0.2 * (g - moment[i])
                params[i] *= 1 - DECAY
                params[i] -= RATE[i] * moment[i] / max(float(np.abs(moment[i]).max()), 1e-12)
    side = softmax[:, 1] - softmax[:, 0]
    model = Model((table @ side).astype(np.float32), 0.0)
    # the offset at which THRESHOLD parts the sample's texts best
    highest = _highest(model, vocabulary, code, owner, len(texts))
    order = np.argsort(highest)
    wrong = np.cumsum(toxic[order]) / toxic.sum() + 1 - np.cumsum(~toxic[order]) / (~toxic).sum()
    at = int(wrong[:-1].argmin())
    cut = (highest[order][at] + highest[order][at + 1]) / 2
    return Model(model.cells, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut))


def _highest(model: Model, vocabulary: pa.Array, code: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The logit of each text's highest window; the offset for a text without a word."""
    out = np.full(n, model.offset)
    if len(code):
        cell, cell_start = grams(vocabulary)
        word = _means(model.cells[cell].astype(np.float64), cell_start)
        starts, text = _windows(owner, n)
        top = np.full(n, -np.inf)
        np.maximum.at(top, text, np.add.reduceat(word[code], starts) / WINDOW + model.offset)
        out[text] = top[text]
    return out


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The highest window's probability of label 1, for each text."""
    if not np.isfinite(model.offset):
        return np.zeros(len(texts))
    logit = _highest(model, *words(texts), len(texts))
    return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        vocabulary, code, owner = words(batch.column("text"))
        names = np.array(vocabulary.to_pylist(), dtype=object)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        out = []
        for i, place in enumerate(batch.column("place").to_pylist()):
            own = code[bounds[i]:bounds[i + 1]]
            at = place % max(1, len(own) - SAMPLE_WORDS + 1)
            out.append(" ".join(names[own[at:at + SAMPLE_WORDS]]))
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("place"), pa.array(out, pa.string())],
                                         names=["toxic", "place", "text"])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on a hashed sample of the documents that ``labels`` names.

    About ``2 * sample_docs * SAMPLE_WORDS`` words reach the driver.
    """
    marks = (labels.where(F.col(f"`{toxic}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("id"))
             .agg(F.max(F.col(f"`{toxic}`").cast("int")).alias("toxic"))
             .withColumn("place", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(1 << 40))))
    count = {r.toxic: r["n"] for r in marks.where("toxic in (0, 1)").groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return Model(np.zeros(CELLS, np.float32), -np.inf)
    share = F.when(F.col("toxic") == 1, sample_docs / count[1]).otherwise(sample_docs / count[0])
    drawn = marks.where("toxic in (0, 1)").where(F.col("place") < share * F.lit(float(1 << 40)))
    # about 2 * sample_docs rows of numbers at any corpus size: broadcast, so that no text moves
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(
        F.broadcast(drawn), "id").select("toxic", "place", "text")
    got = rows.mapInArrow(_stretches, "toxic int, place long, text string").toArrow().sort_by(
        [("place", "ascending"), ("text", "ascending")])
    return fit(got.column("text").to_pylist(), got.column("toxic").to_numpy())


def _scorer(model: Model, keep: list[str]) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(scores(model, batch.column("text")), pa.float64())],
                names=[*keep, "score"])

    return score


def score(docs: DataFrame, model: Model, *keep: Column, text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score``. No shuffle."""
    rows = docs.select(*keep, F.col(f"`{text}`").cast("string").alias("text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_scorer(model, rows.columns[:-1]), schema + "score double")
