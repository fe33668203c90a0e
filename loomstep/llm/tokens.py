"""Token ids of whole texts by a public tokenizer, word by word with a bounded cache.

The tokenizer drops white space and never joins what ASCII white space separates, nor a run of letters and the punctuation
behind it. So the ids of a text are those of its words in a row, and most words are a run of letters and a tail. Arrow parts
the distinct words of a slice. Runs are cached, up to a number of runs and of ids; those that the cache has not seen are encoded
together, many in one text, and told apart by the marker that ends each run's last token.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import cache, coded_words, slices, starts_of

END = 2  # fixed value: the id that closes a document
CACHE_RUNS, CACHE_IDS, TOGETHER = 200_000, 2 << 20, 512
ENCODED_BYTES, ENCODED_TEXTS = 2 << 20, 16
TAIL = ".,;:!?()[]{}<>|*&%$#@+=~^_/\\\"-"  # no apostrophe: it may begin a contraction
# Letters of all Unicode versions that NFC leaves alone next to each other, each with one lower-case form.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿĀ-įı-ſΑ-ΡΣ-Ωα-ωЀ-џ\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
PLAIN = f"^[{LETTERS}]+$"
RUN_END = "</w>"  # fixed value: how a token that ends a run is written


class WordTokenizer:
    def __init__(self, path: str, cache_runs: int = CACHE_RUNS, cache_ids: int = CACHE_IDS) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and each thread keeps memory of its own
        self.tokenizer = Tokenizer.from_file(path)
        # For runs of LETTERS in lower case there is nothing to normalise, and white space alone parts them.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.cache_runs, self.cache_ids = cache_runs, cache_ids
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(RUN_END)]] = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.pool, self.used = np.empty(1 << 20, np.uint32), 0
        self.start, self.size, self.slices = (np.zeros(1 << 16, np.int64) for _ in range(3))

    def _shrink(self) -> None:
        """Keep what more than one slice had, if that is half the cache or less. Most runs of a long tail never come again, and
        long ones (whole sentences, where no space parts words) fill the cache by their ids."""
        place, old = self.place, self.slices[: len(self.place)] > 1
        old[0] = False
        places = np.flatnonzero(old)
        names = list(itertools.compress(place, old))  # places are in the order of the dictionary
        ids, size = self._gather(places)
        self._clear()
        if 2 * len(names) <= self.cache_runs and 2 * len(ids) <= self.cache_ids:
            self._keep(names, ids, size)

    def _ids(self, tokenizer: object, texts: list[str]) -> list[np.ndarray]:
        """A few texts at a time: until its ids are read, an encoding holds over a hundred bytes for each."""
        parts = (texts[k : k + ENCODED_TEXTS] for k in range(0, len(texts), ENCODED_TEXTS))
        return [np.array(x.ids, np.uint32) for part in parts for x in tokenizer.encode_batch_fast(part, add_special_tokens=False)]

    def _keep(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, total = len(self.place), len(ids)
        if n + len(names) > len(self.start):
            more = np.zeros(n + len(names), np.int64)
            self.start, self.size, self.slices = (np.r_[x, more] for x in (self.start, self.size, self.slices))
        if self.used + total > len(self.pool):
            self.pool = np.r_[self.pool, np.empty(len(self.pool) + total, np.uint32)]
        self.start[n : n + len(names)] = self.used + starts_of(sizes)
        self.size[n : n + len(names)] = sizes
        self.pool[self.used : self.used + total] = ids
        self.used += total
        self.place.update(zip(names, range(n, n + len(names))))

    def _add(self, fresh: list[str], plain: bool) -> None:
        """Letter runs in bulk; whatever else there is, and bulks that do not come apart as they should, one by one."""
        runs, single = (fresh, []) if plain else ([], [])
        if not plain:
            for w in fresh:
                (runs if w.isascii() and w.isalpha() or unicodedata.normalize("NFC", w).lower().isalpha() else single).append(w)
        bulks = [runs[k : k + TOGETHER] for k in range(0, len(runs), TOGETHER)]
        for names, ids in zip(bulks, self._ids(self.plain if plain else self.tokenizer, [" ".join(b) for b in bulks])):
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(names) and last[-1] == len(ids) - 1:
                self._keep(names, ids, np.diff(last, prepend=-1))
            else:
                single += names
        if single:
            each = self._ids(self.tokenizer, single)
            self._keep(single, np.concatenate(each), np.fromiter(map(len, each), np.int64, len(each)))

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at places in a row, and how many each has."""
        size = self.size[places]
        return self.pool[np.repeat(self.start[places] - starts_of(size), size) + np.arange(int(size.sum()))], size

    def _places(self, distinct: pa.Array, plain: bool = False) -> np.ndarray:
        names = distinct.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.place.get, names, itertools.repeat(-1)), np.int64, len(names))
        if len(new := np.flatnonzero(places < 0)):
            fresh = [names[k] for k in new]
            self._add(fresh, plain)
            places[new] = [self.place[w] for w in fresh]
        self.slices[places] += 1
        return places

    def _distinct(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) > self.cache_runs or self.used > self.cache_ids:
            self._shrink()
        distinct = distinct.cast(pa.string())
        run = pc.ascii_rtrim(distinct, characters=TAIL)
        plain = pc.match_substring_regex(run, PLAIN)
        some = plain.to_numpy(zero_copy_only=False)
        places = np.zeros((len(distinct), 2), np.int64)
        places[~some, 0] = self._places(distinct.filter(pc.invert(plain)))
        run, whole = run.filter(plain), distinct.filter(plain)
        # Words that differ in case only have the same ids.
        for k, part in enumerate((pc.utf8_lower(run), _behind(run, whole))):
            coded = part.dictionary_encode()
            places[some, k] = self._places(coded.dictionary, k == 0)[coded.indices.to_numpy()]
        ids, size = self._gather(places.ravel())
        return ids, size.reshape(-1, 2).sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): all documents' ids in a row, each closed by END, and how many ids each document has."""
        coded, per_doc = coded_words(texts)
        pool, of = self._distinct(coded.dictionary)
        # END is one more word, behind each document's own.
        pool, of, ends = np.append(pool, np.uint32(END)), np.append(of, 1), np.cumsum(per_doc)
        index = np.insert(coded.indices.to_numpy(), ends, len(of) - 1)
        size = of[index]
        done = np.cumsum(size)
        total = int(size.sum())
        narrow = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
        ids = pool[np.repeat((starts_of(of)[index] - (done - size)).astype(narrow), size) + np.arange(total, dtype=narrow)]
        return ids, np.diff(done[ends + np.arange(len(ends))], prepend=0)

    def encode_slices(self, batches: Iterable[pa.RecordBatch], text: int, most_bytes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(slice, ids, sizes) for each slice of the batches in order; of slices in a row, ENCODED_BYTES of text are encoded at once,
        as many words come once in a slice and again in the next."""
        held, held_bytes = [], 0

        def done() -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
            ids, sizes = self.encode(pa.concat_arrays([x.column(text) for x in held]))
            row = at = 0
            for x in held:
                own = sizes[row : row + x.num_rows]
                n = int(own.sum())
                yield x, ids[at : at + n], own
                row, at = row + x.num_rows, at + n

        for batch in batches:
            for x in slices(batch, text, most_bytes):
                n = pc.sum(pc.binary_length(x.column(text))).as_py() or 0
                if held and held_bytes + n > ENCODED_BYTES:
                    yield from done()
                    held, held_bytes = [], 0
                held.append(x)
                held_bytes += n
        if held:
            yield from done()


def _behind(start: pa.Array, whole: pa.Array) -> pa.Array:
    """What each of ``whole`` has behind its ``start``."""
    stops = np.frombuffer(whole.buffers()[1], np.int32)[: len(whole) + 1][1:].astype(np.int64) if len(whole) else np.empty(0, np.int64)
    size = (pc.binary_length(whole).to_numpy() - pc.binary_length(start).to_numpy()).astype(np.int64)
    at = np.repeat(stops - size - starts_of(size), size) + np.arange(int(size.sum()))
    raw = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[at]
    return pa.Array.from_buffers(pa.string(), len(whole), [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.py_buffer(raw)])


_loaded: dict[str, WordTokenizer] = cache()


def tokenizer(path: str) -> WordTokenizer:
    """One for each path and worker process, as its cache pays off over tasks of one stage."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]
