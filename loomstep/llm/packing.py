"""Order-preserving packing by dynamic programming over document and sentence boundaries.

The documents of a partition, in their order, form a row of ids. A window is a stretch of at most ``window`` ids between two
cuts; cuts may fall at document ends (free), at sentence ends (``sentence`` per cut, as it parts a document) and, inside a
sentence longer than a window, every ``window / 4`` ids (``hard``). The least total of padding and penalties to each cut is

    best(j) = penalty(j) + window - position(j) + min over cuts i with position(j) - position(i) <= window of (best(i) + position(i))

and that minimum over a sliding range comes from a monotone queue, so the work is linear in the cuts. Rows of ids are solved
in stretches of bounded size; the last window of a stretch goes on into the next, so only a partition's end is left short.
No exchange is needed: partitions are packed where they are read.

Defined results: a null text counts as empty and is its closing id alone; ids that are null or repeated pass through; extra
columns are ignored; an empty table gives an empty result; a text longer than a window is cut, never shortened.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import starts_of, tidy
from .common import bounded_batches, text_of
from .tokens import END, tokenizer

WINDOW, SENTENCE, HARD = 4096, 8, 512
SLICE_BYTES = 2 << 20
SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
SENTENCE_ENDS = (".</w>", "!</w>", "?</w>", "...</w>", "!!</w>", "?!</w>")  # fixed values: tokens that close a sentence


def cuts(ids: np.ndarray, doc_ends: np.ndarray, is_end: np.ndarray, window: int, sentence: float, hard: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, from 0 up, and the penalty of each."""
    total = len(ids)
    after = np.flatnonzero(is_end[ids]) + 1
    penalty = np.full(total + 1, np.inf, np.float32)
    penalty[after] = sentence
    penalty[doc_ends] = 0
    penalty[[0, total]] = 0
    at = np.flatnonzero(penalty < np.inf)
    step = window // 4
    for k in np.flatnonzero(np.diff(at) > window):
        extra = np.arange(at[k] + step, at[k + 1], step)
        penalty[extra] = hard
    at = np.flatnonzero(penalty < np.inf)
    return at, penalty[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """The ends of the windows of least total padding and penalty."""
    at_list, cost = at.tolist(), penalty.tolist()
    came = [0] * len(at_list)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # (best + position, position, cut), the least in front
    for j in range(1, len(at_list)):
        here = at_list[j]
        while queue[0][1] < here - window:
            queue.popleft()
        value, _, came[j] = queue[0]
        value += cost[j] + window  # best(j) + position(j)
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, here, j))
    ends, j = [], len(at_list) - 1
    while j:
        ends.append(at_list[j])
        j = came[j]
    return ends[::-1]


class _Packer:
    """Takes documents in order, gives pieces; holds the ids of the window that is not closed yet."""

    def __init__(self, is_end: np.ndarray, window: int, sentence: float, hard: float) -> None:
        self.is_end, self.window, self.sentence, self.hard = is_end, window, sentence, hard
        self.ids, self.docs, self.next = np.empty(0, np.uint32), [], TaskContext.get().partitionId() << 32 if TaskContext.get() else 0

    def add(self, ids: np.ndarray, docs: list[tuple[object, int, int, int]], last: bool) -> Iterator[tuple]:
        """docs: (id, first id's place in its document, ids here, ids of the document)."""
        ids, docs = np.concatenate([self.ids, ids]), self.docs + docs
        if not len(ids):
            return
        sizes = np.fromiter((d[2] for d in docs), np.int64, len(docs))
        starts = starts_of(sizes)
        ends = best_cuts(*cuts(ids, starts + sizes, self.is_end, self.window, self.sentence, self.hard), self.window)
        keep = len(ids) if last else ([0, *ends])[-2]
        windows = np.array([0, *ends][:-1])
        edges = np.union1d(starts, windows)
        doc = np.searchsorted(starts, edges, "right") - 1
        seq = np.searchsorted(windows, edges, "right") - 1
        stop = np.append(edges[1:], len(ids))
        self.ids, self.docs = ids[keep:], []
        raw = ids.astype("<u4").tobytes()
        for a, b, d, s in zip(edges.tolist(), stop.tolist(), doc.tolist(), seq.tolist()):
            name, first, _, whole = docs[d]
            start = first + a - int(starts[d])
            if a >= keep:
                self.docs.append((name, start, b - a, whole))
            else:
                yield name, start, b - a, whole, self.next + s, a - int(windows[s]), raw[4 * a : 4 * b]
        self.next += len(windows) - (not last)


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, sentence: float = SENTENCE, hard: float = HARD) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids): one row for each piece, ids as little-endian uint32."""
    kind = df.schema[id_col].dataType.simpleString()
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(tokenizer_path)
        is_end = np.zeros(len(own.ends), bool)
        is_end[[i for x in SENTENCE_ENDS if (i := own.tokenizer.token_to_id(x)) is not None]] = True
        packer, id_type = _Packer(is_end, window, sentence, hard), None

        def out(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            columns = list(zip(*rows))
            if columns:
                kinds = [id_type, *[pa.int64()] * 5, pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for part, ids, sizes in own.encode_slices(batches, 1, SLICE_BYTES):
            id_type = part.column(0).type
            docs = [(name, 0, n, n) for name, n in zip(part.column(0).to_pylist(), sizes.tolist())]
            yield from out(packer.add(ids, docs, False))
        yield from out(packer.add(np.empty(0, np.uint32), [], True))

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(tidy(run, cached=True), f"id {kind}, {SCHEMA}")
