"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

A text's bytes are laid out in windows of ``window`` bytes; in each, one network reads forwards and one backwards, both gated
(update and reset gate), and every byte gets a language distribution from the two states around it. A document's distribution
is the mean of its bytes' distributions, over all bytes of the whole text. Training is backpropagation through time with
adaptive steps on windows of a bounded sample of documents, each labelled with its document's language. Gates use
x / (1 + |x|) in place of the exponential sigmoid, which numpy computes several times as fast.

Defined results: a null text or one without a letter is ``und`` with score 0; without any language to learn every text is
``und``; rows, null and repeated ids pass one for one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices, starts_of

PER_LANG, WINDOW, HIDDEN = 300, 96, 8
STEPS, BATCH, RATE = 260, 384, 0.02
SLICE_BYTES, LANES = 4 << 20, 4096
PAD = 256
UNKNOWN = "und"


def layout(texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows x window bytes, PAD after a text's end; the text that each window is of)."""
    whole = pc.fill_null(texts, "")
    size = pc.binary_length(whole).to_numpy(zero_copy_only=False).astype(np.int64)
    raw = np.frombuffer(b"".join(x.as_buffer() for x in whole.cast(pa.binary())), np.uint8)
    count = -(-size // window)
    doc = np.repeat(np.arange(len(size)), count)
    out = np.full(int(count.sum()) * window, PAD, np.int16)
    text = np.repeat(np.arange(len(size)), size)
    out[np.arange(len(raw)) + (starts_of(count) * window - starts_of(size))[text]] = raw
    return out.reshape(-1, window), doc


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Direction:
    """Weights of one direction: byte inputs of both gates and the candidate (3H x 257), recurrent ones, and the output's."""

    inputs: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray
    out: np.ndarray

    def run(self, seen: np.ndarray, keep: bool = False):
        """States after each byte, H x lanes each; ``seen`` is window x lanes. With ``keep``, what learning needs as well."""
        size = len(self.candidate)
        h = np.zeros((size, seen.shape[1]), np.float32)
        states, tape = [], []
        half = np.float32(0.5)
        for t in range(len(seen)):
            x = np.take(self.inputs, seen[t], axis=1)
            a = self.gates @ h
            a += x[: 2 * size]
            g = np.abs(a)
            g += 1
            np.divide(a, g, out=g)
            g *= half
            g += half  # update gate, reset gate
            z, r = g[:size], g[size:]
            rh = r * h
            c = self.candidate @ rh
            c += x[2 * size :]
            s = np.abs(c)
            s += 1
            new = c / s
            new -= h
            step = z * new
            if keep:
                tape.append((h, a, z, r, rh, c, new))
            h = h + step
            states.append(h)
        return (states, tape) if keep else states

    def forward(self, seen: np.ndarray, states: np.ndarray) -> None:
        """Fills ``states`` (window x H x lanes) as :meth:`run` does, in place: both halvings are drawn out of the gates."""
        size, lanes = len(self.candidate), seen.shape[1]
        x, a, g = np.empty((3 * size, lanes), np.float32), np.empty((2 * size, lanes), np.float32), np.empty((2 * size, lanes), np.float32)
        rh, c, s = (np.empty((size, lanes), np.float32) for _ in range(3))
        h, halved, half = np.zeros((size, lanes), np.float32), self.candidate * np.float32(0.5), np.float32(0.5)
        for t in range(len(seen)):
            np.take(self.inputs, seen[t], axis=1, out=x, mode="clip")
            np.matmul(self.gates, h, out=a)
            a += x[: 2 * size]
            np.abs(a, out=g)
            g += 1
            np.divide(a, g, out=g)  # gates are (1 + g) / 2
            np.multiply(g[size:], h, out=rh)
            rh += h
            np.matmul(halved, rh, out=c)
            c += x[2 * size :]
            np.abs(c, out=s)
            s += 1
            c /= s
            c -= h
            np.multiply(g[:size], c, out=s)
            s += c
            s *= half
            h = np.add(h, s, out=states[t])

    def learn(self, seen: np.ndarray, tape: list, outer: list[np.ndarray]) -> list[np.ndarray]:
        """Gradients of inputs, gates and candidate from those of the states (``outer``), back through time."""
        size = len(self.candidate)
        d_in, d_gates, d_candidate = np.zeros_like(self.inputs), np.zeros_like(self.gates), np.zeros_like(self.candidate)
        back = np.zeros_like(outer[0])
        for t in range(len(seen) - 1, -1, -1):
            h, a, z, r, rh, c, new = tape[t]
            d = outer[t] + back
            d_c = d * z / (1 + np.abs(c)) ** 2
            d_rh = self.candidate.T @ d_c
            d_a = np.concatenate([d * new, d_rh * h]) * 0.5 / (1 + np.abs(a)) ** 2
            d_candidate += d_c @ rh.T
            d_gates += d_a @ h.T
            back = d * (1 - z) + d_rh * r + self.gates.T @ d_a
            for k, row in enumerate(np.concatenate([d_a, d_c])):
                d_in[k] += np.bincount(seen[t], row, minlength=PAD + 1)
        return [d_in, d_gates, d_candidate]


@dataclass
class Model:
    langs: list[str]
    window: int
    ahead: Direction | None
    back: Direction | None
    bias: np.ndarray | None

    def positions(self, seen: np.ndarray) -> np.ndarray:
        """Distributions, window x languages x lanes."""
        size, lanes = len(self.bias), seen.shape[1]
        states, out = np.empty((len(seen), len(self.ahead.candidate), lanes), np.float32), np.empty((len(seen), size, lanes), np.float32)
        self.ahead.forward(seen, states)
        np.matmul(self.ahead.out, states, out=out)
        self.back.forward(seen[::-1], states)
        out += np.matmul(self.back.out, states)[::-1]
        out += self.bias[:, None]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def documents(self, texts: pa.Array) -> np.ndarray:
        """Mean distribution over all bytes of each text (0 for empty ones)."""
        rows, doc = layout(texts, self.window)
        total, count = np.zeros((len(texts), len(self.langs))), np.bincount(doc, (rows != PAD).sum(axis=1), minlength=len(texts))
        for at in range(0, len(rows), LANES):
            seen = np.ascontiguousarray(rows[at : at + LANES].T)
            p = self.positions(seen)
            short = np.flatnonzero(seen[-1] == PAD)
            p[:, :, short] *= (seen[:, short] != PAD)[:, None, :]
            np.add.at(total, doc[at : at + LANES], p.sum(axis=0, dtype=np.float64).T)
        return total / np.maximum(count, 1)[:, None]


def fit(texts: list[str], langs: list[str], window: int = WINDOW, hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> Model:
    names = sorted(set(langs))
    if len(names) < 2:
        return Model(names, window, None, None, None)
    rng = np.random.default_rng(seed)
    rows, doc = layout(pa.array(texts, pa.string()), window)
    y = np.searchsorted(names, langs)[doc]
    by_lang = [np.flatnonzero((y == k) & (rows[:, window // 2] != PAD)) for k in range(len(names))]
    by_lang = [r if len(r) else np.flatnonzero(y == k) for k, r in enumerate(by_lang)]

    def fresh() -> Direction:
        inputs = rng.normal(0, 0.5, (3 * hidden, PAD + 1)).astype(np.float32)
        inputs[:hidden] -= 1.0  # slow updates at first: longer memory
        return Direction(inputs, rng.normal(0, 0.3, (2 * hidden, hidden)).astype(np.float32), rng.normal(0, 0.3, (hidden, hidden)).astype(np.float32), rng.normal(0, 0.3, (len(names), hidden)).astype(np.float32))

    model = Model(names, window, fresh(), fresh(), np.zeros(len(names), np.float32))
    own = [*vars(model.ahead).values(), *vars(model.back).values(), model.bias]
    mean, square = [np.zeros_like(x) for x in own], [np.zeros_like(x) for x in own]
    for n in range(1, steps + 1):
        pick = np.concatenate([rng.choice(r, batch // len(names) + 1) for r in by_lang if len(r)])
        seen, label = np.ascontiguousarray(rows[pick].T), y[pick]
        (first, tape_a), (second, tape_b) = model.ahead.run(seen, True), model.back.run(seen[::-1], True)
        valid = (seen != PAD).astype(np.float32) / max(1, int((seen != PAD).sum()))
        d_first, d_second = [], []
        grads = [np.zeros_like(x) for x in own]
        for t in range(window):
            h, g = first[t], second[window - 1 - t]
            o = model.ahead.out @ h + model.back.out @ g + model.bias[:, None]
            o = np.exp(o - o.max(axis=0))
            o /= o.sum(axis=0)
            o[label, np.arange(len(label))] -= 1
            o *= valid[t]
            grads[3] += o @ h.T
            grads[7] += o @ g.T
            grads[8] += o.sum(axis=1)
            d_first.append(model.ahead.out.T @ o)
            d_second.append(model.back.out.T @ o)
        grads[:3] = model.ahead.learn(seen, tape_a, d_first)
        grads[4:7] = model.back.learn(seen[::-1], tape_b, d_second[::-1])
        now = rate * min(1.0, 2 * (1 - n / (steps + 1)))
        for x, g, m, v in zip(own, grads, mean, square):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= now * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
    for d in (model.ahead, model.back):  # a byte that is not there changes nothing
        d.inputs[:, PAD] = 0
        d.inputs[:hidden, PAD] = -1e9
    return model


def train(docs: DataFrame, learn: Column, per_lang: int = PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> Model:
    """From at most ``per_lang`` documents of every language, those of least id hash; texts under 40 characters come last. Of a
    repeated id the row of the least language and text is learned."""
    able = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    keys = able.select(id_col, lang_col, (F.length(text_col) < 40).alias("short"), F.xxhash64(id_col).alias("h"))
    first = Window.partitionBy(lang_col).orderBy("short", "h", id_col)  # limited before the exchange
    pick = keys.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang)
    if pick.isEmpty():
        return fit([], [], **how)
    few = docs.sparkSession.createDataFrame(pick.select(id_col).distinct().toPandas())  # at most per_lang ids of a language
    chosen = able.select(F.col(id_col).alias("id"), F.struct(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).alias("row")).join(F.broadcast(few.withColumnRenamed(id_col, "id")), "id", "left_semi")
    rows = chosen.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.lang", "row.text").toPandas().sort_values("id")
    return fit(rows["text"].tolist(), rows["lang"].tolist(), **how)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score): one row for each row."""
    kind = df.schema[id_col].dataType.simpleString()
    known = df.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        names = np.array([*own.langs, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                letter = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                if own.ahead is None:
                    best, score = np.zeros(len(part), int), np.full(len(part), float(len(own.langs)))
                else:
                    p = own.documents(part.column(1))
                    best = p.argmax(axis=1)
                    score = p[np.arange(len(p)), best]
                best, score = np.where(letter, best, len(own.langs)), np.where(letter, score, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))], ["id", "lang", "score"])

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), letters.alias("letters")).mapInArrow(run, f"id {kind}, lang string, score double")
