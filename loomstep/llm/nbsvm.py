"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes log-count ratios.

Indicators are of byte n-grams (1 to 3 bytes) and of word-shape n-grams (1 to 3 words), a word's shape being its letter case
and its ending, or "as before" for a word that repeats its predecessor. An indicator's weight is multiplied by its log-count
ratio between the classes, and the hinge loss is minimised by dual coordinate descent. Margins become probabilities by a
sigmoid fitted on folds that did not see them. Training sees a bounded sample; scoring reads every whole text.

Defined results: null and empty texts score as a text without n-grams; without labels of both classes every score is the
share of label 1 (0.5 without any); rows, null and repeated ids pass one for one; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import Words, slices, starts_of, tidy, words
from .common import bounded_batches
from .training import labelled_sample, platt, probability

PER_CLASS, SLICE_BYTES, FOLDS, ROWS = 2500, 1 << 20, 3, 512
SMOOTH, LEAST_DOCS = 1.0, 4
COST, EPOCHS = 0.05, 12
SHAPE_BITS, SHAPES = 6, 62
SHAPE_AT = 1 << 24  # codes below are byte n-grams with their length, codes from here are of shapes


def _shape(word: str) -> int:
    """Five letter cases times twelve endings."""
    core = word.rstrip(".,;:!?%&$#*|)\"'")
    case = 0 if not core else 1 if core.isdigit() else 2 if core.islower() else 3 if core.isupper() and len(core) > 1 else 4
    tail = word[len(core) :]
    end = 0 if not tail else 1 + ".,;:!?%&$#*".find(tail[0]) if len(tail) == 1 else 0 if tail[0] == "|" else 11
    if len(tail) > 1 and tail[0] not in ".,":
        end = 9 if tail[0] in "!?" else 10
    return 1 + case * 12 + min(end, 11)


def _shape_grams(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, code) of every shape n-gram, by length."""
    shape = np.fromiter(map(_shape, w.distinct), np.int64, len(w.distinct))[w.index]
    same = np.zeros(len(shape), bool)
    same[1:] = (w.index[1:] == w.index[:-1]) & (w.doc[1:] == w.doc[:-1])
    shape[same] = SHAPES
    code = np.zeros(len(shape), np.int64)
    for n in range(3):
        code = (code[: len(shape) - n] << SHAPE_BITS) | shape[n:]
        inside = w.doc[: len(code)] == w.doc[n:]
        yield w.doc[n:][inside], (n << 18) + code[inside]


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and each text's number of bytes."""
    whole = pc.fill_null(texts, "")
    sizes = pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b"".join(x.as_buffer() for x in whole.cast(pa.binary()))
    return np.frombuffer(joined, np.uint8), sizes


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, code) of every n-gram of every text."""
    raw, sizes = _text_bytes(texts)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    code = np.zeros(len(raw), np.int32)
    for n in range(3):
        code = (code[: len(raw) - n] << 8) | raw[n:] if n < len(raw) else code[:0]
        if n == 0:
            yield doc, SHAPE_AT + (1 << 20) + code
        elif n == 1:
            inside = doc[: len(code)] == doc[n:]
            yield doc[n:][inside], SHAPE_AT + (1 << 21) + code[inside]
        else:
            inside = doc[: len(code)] == doc[n:]
            yield doc[n:][inside], code[inside]
    for d, c in _shape_grams(words(texts)):
        yield d, SHAPE_AT + c


CODES = SHAPE_AT + (1 << 21) + (1 << 16)


@dataclass
class Model:
    codes: np.ndarray  # the n-grams with a weight
    weights: np.ndarray
    bias: float
    a: float
    b: float
    constant: float | None = None

    def table(self) -> np.ndarray:
        kind = np.int16 if len(self.codes) < 1 << 15 else np.int32
        at = np.full(CODES, -1, kind)
        at[self.codes] = np.arange(len(self.codes), dtype=kind)
        return at

    def margins(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        """A matrix of which text has which n-gram is held for ROWS texts at a time, however short they are."""
        out = np.empty(len(texts), np.float32)
        for first in range(0, len(texts), ROWS):
            part = texts[first : first + ROWS]
            seen = np.zeros((len(part), len(self.codes)), bool)
            for doc, code in grams(part):
                at = table[code]
                known = at >= 0
                seen[doc[known], at[known]] = True
            out[first : first + ROWS] = seen @ self.weights + np.float32(self.bias)
        return out

    def scores(self, texts: pa.Array, table: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return probability(self.margins(texts, table).astype(float), self.a, self.b)


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) of the linear machine min |w|^2 / 2 + sum cost_i max(0, 1 - y_i w.x_i), where x_i
    is ``values`` at rows[i] and zero elsewhere."""
    rng, w = np.random.default_rng(seed), np.zeros(len(values) + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([(values[r] ** 2).sum() + 1.0 for r in rows])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            r = rows[i]
            gradient = y[i] * (w[r] @ values[r] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if step := (new - alpha[i]) * y[i]:
                alpha[i] = new
                w[r] += step * values[r]
                w[-1] += step
    return w


def fit(texts: list[str], y: np.ndarray, smooth: float = SMOOTH, cost: float = COST, epochs: int = EPOCHS, least_docs: int = LEAST_DOCS) -> Model:
    y = np.asarray(y, int)
    if len(set(y.tolist())) < 2:
        return Model(np.empty(0, np.int64), np.empty(0, np.float32), 0.0, 1.0, 0.0, float(y.mean()) if len(y) else 0.5)
    pairs = []
    for part in slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(np.arange(len(texts)))], ["t", "i"]), 0, SLICE_BYTES):
        first = part.column(1)[0].as_py()
        found = [np.unique(d.astype(np.int64) * CODES + c) for d, c in grams(part.column(0))]
        pairs.append(np.concatenate(found) + first * CODES)
    pairs = np.sort(np.concatenate(pairs))
    doc, code = (pairs // CODES).astype(np.int32), (pairs % CODES).astype(np.int32)
    del pairs
    codes, index, count = np.unique(code, return_inverse=True, return_counts=True)
    often = count >= min(least_docs, max(1, len(y) // 10))
    some, new = often[index], np.cumsum(often) - 1
    doc, index, codes = doc[some], new[index[some]], codes[often].astype(np.int64)
    rows = np.split(index, np.cumsum(np.bincount(doc, minlength=len(y)))[:-1])

    def learn(on: np.ndarray) -> tuple[np.ndarray, float]:
        size = len(codes)
        p = smooth + np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(on & (y == 1))] or [index[:0]]), minlength=size)
        q = smooth + np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(on & (y == 0))] or [index[:0]]), minlength=size)
        ratio = np.log(p / p.sum()) - np.log(q / q.sum())
        mine = np.flatnonzero(on)
        share = np.where(y[mine] == 1, len(mine) / (2 * max(1, (y[mine] == 1).sum())), len(mine) / (2 * max(1, (y[mine] == 0).sum())))
        w = dual_coordinate_descent([rows[i] for i in mine], ratio, np.where(y[mine] == 1, 1.0, -1.0), cost * share, epochs)
        return w[:-1] * ratio, float(w[-1])

    fold, margins = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        if len(set(y[fold != k].tolist())) == 2:
            w, bias = learn(fold != k)
            for i in np.flatnonzero(fold == k):
                margins[i] = w[rows[i]].sum() + bias
    a, b = platt(margins, y)
    w, bias = learn(np.ones(len(y), bool))
    some = w != 0
    return Model(codes[some], w[some].astype(np.float32), bias, a, b)


def train(docs: DataFrame, marks: DataFrame, label: str, learn: Column, per_class: int = PER_CLASS, **how) -> Model:
    sample: pd.DataFrame = labelled_sample(docs, marks, label, learn, per_class)
    return fit(sample["text"].tolist(), sample["y"].to_numpy(), **how)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of label 1 for each row."""
    kind = df.schema[id_col].dataType.simpleString()
    known = df.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value.table()
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(known.value.scores(part.column(1), table))], ["id", "score"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")


def accepted(df: DataFrame, model: Model, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose score is at least ``least``, in its columns and without an exchange: the filter runs where
    the rows are."""
    known, at, schema = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_col), df.schema
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value.table()
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                yield part.filter(pa.array(known.value.scores(part.column(at), table) >= least))

    return df.mapInArrow(tidy(run), schema)
