"""Toxicity by a linear-chain conditional random field over words.

Labels come per document, so token labels are derived first: among attributes of words (the word, its leading
letters) those that many toxic documents have and next to no others are picked, then one after another those that explain most toxic
documents not explained yet; words with such an attribute in a toxic document are labelled toxic. A
two-state chain is then fitted to those sequences: unary weights of a word's attributes and of its neighbours, and
transition weights, by gradient ascent on the conditional likelihood with forward-backward. Scoring runs forward-backward
over every whole text; a word's marginal is its probability to be toxic, and a document's score is the highest of its words'
marginals, so that a text's length alone moves no score. Spans are runs of words above one half, with offsets.

Defined results: null and empty texts score 0 and have no span; without toxic labels every score is 0; where no attribute is
as pure as asked (labels with noise), less pure ones are taken, step by step down to two in three; rows, null and repeated ids
pass one for one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import slices, starts_of, words
from .common import WORD
from .training import labelled_sample

PER_CLASS, SLICE_BYTES = 1200, 16 << 20
LEAST_DOCS, PURITIES, COMMON = 3, (0.98, 0.95, 0.9, 0.8, 0.67), 0.03
SEGMENT, STEPS, RATE, L2, OTHERS = 64, 60, 0.3, 0.1, 8
EDGE = ".,;:!?%&$#*|()[]\"'"


def attributes(word: str) -> tuple[str, str, str, str]:
    """The word itself and its leading four, five and seven letters."""
    core = word.strip(EDGE).lower() or word
    return core, "4" + core[:4], "5" + core[:5], "7" + core[:7]


def _families(texts: list[str], rows: int = 5, bands: int = 10) -> np.ndarray:
    """A number for each document that near copies share, by min-hashes of longer words; only for counting support."""
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    rng = np.random.default_rng(3)
    mult = rng.integers(1, 1 << 63, rows * bands, dtype=np.uint64) | np.uint64(1)
    seen: dict[tuple, int] = {}
    for i, text in enumerate(texts):
        own = set(text.split())
        long = [w for w in own if len(w) > 5]
        hashes = np.array([zlib.crc32(w.encode()) for w in (long if len(long) > 9 else own)] or [i], np.uint64)
        least = ((hashes[:, None] * mult) >> np.uint64(20)).min(axis=0).tolist()
        for b in range(bands):
            root[find(i)] = find(seen.setdefault((b, *least[b * rows : (b + 1) * rows]), i))
    return np.array([find(i) for i in range(len(texts))], np.int64)


def telling_attributes(texts: list[str], toxic: np.ndarray, least_docs: int = LEAST_DOCS, purities: tuple[float, ...] = PURITIES, common: float = COMMON) -> set[str]:
    """Attributes whose documents are toxic to at least the first of ``purities`` that any reaches, and that are common among
    toxic documents, or that explain toxic documents which the ones picked before do not. Near copies of a document count once."""
    number: dict[str, int] = {}
    of_word: dict[str, list[int]] = {}

    def numbers(text: str) -> np.ndarray:
        for w in set(text.split()):
            if w not in of_word:
                of_word[w] = [number.setdefault(a, len(number)) for a in attributes(w)]
        return np.unique(np.fromiter((n for w in set(text.split()) for n in of_word[w]), np.int32))

    own, bad = [numbers(t) for t in texts], {}
    names, size = list(number), len(number)
    clean = np.bincount(np.concatenate([d for d, y in zip(own, toxic) if not y] or [np.empty(0, np.int32)]), minlength=size)
    for d, y, f in zip(own, toxic, _families(texts).tolist()):
        if y:
            bad[f] = np.intersect1d(bad[f], d) if f in bad else d
    support = np.bincount(np.concatenate([*bad.values()] or [np.empty(0, np.int32)]), minlength=size)
    fair = np.zeros(size, bool)
    for purity in purities:
        fair = (support >= least_docs) & (support >= purity * (support + clean))
        if fair.any():
            break
    picked = fair & (support >= max(least_docs + 1, common * len(bad)))
    left = [d[fair[d]] for d in bad.values() if not picked[d].any()]
    while left:
        count = np.bincount(np.concatenate(left), minlength=size)
        if count.max() < least_docs:
            break
        best = max(np.flatnonzero(count == count.max()).tolist(), key=lambda a: (support[a], len(names[a]), names[a]))
        picked[best] = True
        left = [d for d in left if best not in d]
    return {names[a] for a in np.flatnonzero(picked)}


@dataclass
class Model:
    own: dict[str, float]  # attributes' weights
    before: dict[str, float]  # weights of a word on the word after it
    after: dict[str, float]  # and on the word before it
    bias: float
    step: np.ndarray  # 2 x 2 transition weights

    def unary(self, distinct: list[str]) -> np.ndarray:
        """3 x distinct words: what each adds to the toxic state of the next word, its own, and that of the one before."""
        own, before, after = self.own.get, self.before.get, self.after.get
        found = [(before(a, 0.0), own(a, 0.0) + own(b, 0.0) + own(c, 0.0) + own(d, 0.0), after(a, 0.0)) for a, b, c, d in map(attributes, distinct)]
        return np.array(found).reshape(-1, 3).T

    def marginals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Every word's probability to be toxic, in order, and the words per text."""
        found = words(texts)
        u = self.unary(found.distinct)
        e = u[1][found.index] + self.bias
        joined = found.doc[1:] == found.doc[:-1]
        e[1:] += np.where(joined, u[0][found.index[:-1]], 0)
        e[:-1] += np.where(joined, u[2][found.index[1:]], 0)
        return forward_backward(np.exp(np.clip(e, -30, 30)), found.per_doc, np.exp(self.step))[0], found.per_doc


def forward_backward(odds: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of state 1 in chains laid end to end, and the forward and backward odds they come from. ``odds``: each
    place's unary factor of state 1 to state 0; ``step``: transition factors. All chains advance together, longest first."""
    order = np.argsort(-sizes, kind="stable")
    start, size = starts_of(sizes)[order], sizes[order]
    live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")  # chains with a place t: size > t
    ahead, back = np.array(odds), np.ones(len(odds))
    for t in range(1, len(live)):
        at = start[: live[t]] + t
        r = ahead[at - 1]
        ahead[at] = odds[at] * (step[0, 1] + step[1, 1] * r) / (step[0, 0] + step[1, 0] * r)
    end = start + size
    for t in range(2, len(live) + 1):
        at = end[: live[t - 1]] - t
        r = odds[at + 1] * back[at + 1]
        back[at] = (step[1, 0] + step[1, 1] * r) / (step[0, 0] + step[0, 1] * r)
    both = ahead * back
    return both / (1 + both), ahead, back


def highest(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each chain's highest marginal, 0 for a chain without a place."""
    out = np.zeros(len(sizes))
    np.maximum.at(out, np.repeat(np.arange(len(sizes)), sizes), p)
    return out


def fit(texts: list[str], toxic: np.ndarray, segment: int = SEGMENT, steps: int = STEPS, rate: float = RATE, l2: float = L2) -> Model | None:
    telling = telling_attributes(texts, toxic)
    if not telling:
        return None
    found = words(pa.array(texts, pa.string()))
    own = [attributes(w) for w in found.distinct]
    flag = np.array([bool(telling.intersection(a)) for a in own])
    y = flag[found.index] & (np.asarray(toxic) == 1)[found.doc]
    # Segments with a toxic word, and some more of the others: the chains to learn from.
    chain = np.r_[0, np.cumsum((found.doc[1:] != found.doc[:-1]) | (_within(found.per_doc)[1:] % segment == 0))]
    keep = np.bincount(chain, y) > 0
    rest = np.flatnonzero(~keep)
    keep[rest[:: max(1, len(rest) // max(1, OTHERS * int(keep.sum())))]] = True
    some = keep[chain]
    index, y, chain = found.index[some], y[some], chain[some]
    sizes = np.bincount(np.unique(chain, return_inverse=True)[1])
    used = Counter(a for k in np.unique(index) for a in own[k])
    names = sorted(a for a, n in used.items() if n >= 2 or a in telling)
    place = {a: i for i, a in enumerate(names)}
    at = [[place[a] for a in x if a in place] for x in own]
    word_of = np.repeat(np.arange(len(at)), [len(x) for x in at])
    attr_of = np.array([i for x in at for i in x], np.int64)
    core_of = np.array([place.get(x[0], len(names)) for x in own])  # one place more: of no weight
    inner = np.ones(len(index), bool)
    inner[starts_of(sizes)] = False  # has a word before it in its chain
    w, bias, step = np.zeros((3, len(names) + 1)), -2.0, np.zeros((2, 2))
    square, n, penalty = [np.full_like(w, 1e-3), 1e-3, np.full((2, 2), 1e-3)], len(index), np.array([[10 * l2], [l2], [10 * l2]])
    share = np.bincount(y[1:][inner[1:]].astype(int) + 2 * y[:-1][inner[1:]], minlength=4).reshape(2, 2)
    before, after = core_of[index[:-1]], core_of[index[1:]]
    for _ in range(steps):
        e = np.bincount(word_of, w[1][attr_of], minlength=len(at))[index] + bias
        e[1:] += np.where(inner[1:], w[0][before], 0)
        e[:-1] += np.where(inner[1:], w[2][after], 0)
        factor, odds = np.exp(step), np.exp(np.clip(e, -30, 30))
        p, ahead, back = forward_backward(odds, sizes, factor)
        # Expected transitions: forward before, transition, unary and backward after.
        a, o = ahead[:-1][inner[1:]], (odds * back)[1:][inner[1:]]
        joint = np.stack([factor[0, 0] * np.ones_like(a), factor[0, 1] * o, factor[1, 0] * a, factor[1, 1] * a * o])
        expected = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        gap, size = y - p, len(names) + 1
        g = np.stack([
            np.bincount(before, np.where(inner[1:], gap[1:], 0), minlength=size),
            np.bincount(attr_of, np.bincount(index, gap, minlength=len(at))[word_of], minlength=size),
            np.bincount(after, np.where(inner[1:], gap[:-1], 0), minlength=size),
        ])
        g[:, -1] = 0
        g -= penalty * w
        square[0] += g**2
        w += rate * g / np.sqrt(square[0])
        g = (gap.sum() - l2 * bias) / n
        square[1] += g**2
        bias += rate * g / square[1] ** 0.5
        g = (share - expected - l2 * step) / n
        square[2] += g**2
        step = step + rate * g / np.sqrt(square[2])
    kept = [{names[i]: float(x[i]) for i in np.flatnonzero(np.abs(x[:-1]) > 1e-3)} for x in w]
    return Model(kept[1], kept[0], kept[2], float(bias), step)


def _within(sizes: np.ndarray) -> np.ndarray:
    """Each place's number within its chain."""
    return np.arange(sizes.sum()) - np.repeat(starts_of(sizes), sizes)


def train(docs: DataFrame, marks: DataFrame, label: str, learn: Column, per_class: int = PER_CLASS) -> Model | None:
    sample = labelled_sample(docs, marks, label, learn, per_class)
    return fit(sample["text"].tolist(), sample["y"].to_numpy()) if len(sample) else None


def spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of words above one half, as code-point offsets with the run's highest marginal."""
    out: list[dict] = []
    last = -2
    for k, m in enumerate(re.finditer(WORD, text)):
        if p[k] > 0.5:
            if k == last + 1:
                out[-1] |= {"end": m.end(), "p": max(out[-1]["p"], float(p[k]))}
            else:
                out.append({"start": m.start(), "end": m.end(), "p": float(p[k])})
            last = k
    return out


def tag(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, spans): one row for each row; spans are arrays of (start, end, p)."""
    kind = df.schema[id_col].dataType.simpleString()
    known = df.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                n = len(part)
                score, found = np.zeros(n), [[] for _ in range(n)]
                if known.value is not None:
                    p, sizes = known.value.marginals(part.column(1))
                    score = highest(p, sizes)
                    start = starts_of(sizes)
                    for d in np.unique(np.searchsorted(np.cumsum(sizes), np.flatnonzero(p > 0.5), "right")):
                        found[d] = spans(part.column(1)[int(d)].as_py(), p[start[d] : start[d] + sizes[d]])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.clip(score, 0, 1) + 0.0), pa.array(found, span)], ["id", "score", "spans"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double, spans array<struct<start:bigint,end:bigint,p:double>>")
