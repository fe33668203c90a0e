"""Arrow batches of texts: bounded slices, words as indices into each slice's own distinct words, memory given back between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_caches: list[dict] = []


def cache() -> dict:
    """A dictionary that outlasts a task in its worker process, until a task of ``tidy`` comes that does not ask for it."""
    _caches.append({})
    return _caches[-1]


def give_back(cached: bool) -> None:
    """What was freed goes back to the system, unless ``cached`` the caches as well. A worker's memory is its executor's, and the
    worker goes on to other stages."""
    if not cached:
        for c in _caches:
            c.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], cached: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, in a worker that holds nothing of earlier tasks, and keeps nothing but caches it asks for."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(cached)
        try:
            yield from run(batches)
        finally:
            give_back(cached)

    return own


def slices(batch: pa.RecordBatch, text: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces of at most ``most_bytes`` of text or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(at, stop - at)
        at = stop
        pa.default_memory_pool().release_unused()  # a worker's memory is its executor's


class Words(NamedTuple):
    """Words of a slice in order: which document each is of, its index into ``distinct``, and the words per document."""

    doc: np.ndarray
    index: np.ndarray
    distinct: list[str]
    per_doc: np.ndarray


def coded_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words in order, coded, and how many each document has; empty ones, at white space that begins or ends a text, are among them."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    return lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def words(texts: pa.Array) -> Words:
    """Words are what ASCII white space separates; a null text has none."""
    flat, sizes = coded_words(texts)
    doc, index = np.repeat(np.arange(len(sizes)), sizes), flat.indices.to_numpy(zero_copy_only=False)
    distinct = flat.dictionary.to_pylist()
    if "" in distinct:
        some = index != distinct.index("")
        doc, index = doc[some], index[some]
    return Words(doc, index, distinct, np.bincount(doc, minlength=len(sizes)))


def starts_of(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes
