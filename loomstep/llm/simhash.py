"""SimHash near-duplicates through an inverted index on byte positions.

Fingerprints of 64 bits have eight positional bytes. At most ``bits`` (4) differing bits touch at most four bytes, so a
linked pair is guaranteed ``8 - bits`` equal positional bytes: the count filter. Posting lists of single (position, byte)
entries would have every pair tallied that shares one byte, a 32nd of all pairs. The tally is therefore taken in the index:
there is a posting list for every choice of ``8 - bits`` entries, and two fingerprints meet in one of them exactly when their
tally reaches the guaranteed minimum. Each list is verified by Hamming distance and leaves only a spanning star for each of
its linked groups, never all pairs. Copies are collapsed to one fingerprint before. The members of a list longer than
``hot_list`` are dealt out by the same index one level finer: they differ in the other ``bits`` bytes only, of whose half
bytes a linked pair shares at least half, so every choice of half of those has a list. Such a list has at most 65,536
members (16 free bits), whatever the input.

Defined results: a null text counts as empty; texts without a word have fingerprint zero and link like any other; a null
id keeps its row and takes part in links, but never names a component unless all ids of it are null (then null); repeated
rows each keep a row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import tidy
from .common import Scratch, free_names, text_of, written

SHINGLE, BITS, SEED, HOT_LIST = 4, 4, 42, 16384
BLOCK = 16384  # hashes whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text: a bit is 1 if more than half the shingles' hashes have it."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(b" ".join(words), seed))
    counts, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, BLOCK):
        part = words[at : at + BLOCK + shingle - 1]
        raw = b"".join([digest(b" ".join(w), seed) for w in zip(*(part[k:] for k in range(shingle)))])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes())


def majority(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint of hashes: a bit is 1 if more than half of them have it."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        raw = hashes[at : at + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fp): one row for each row of ``df``; fp is the fingerprint as a signed long."""
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x.as_buffer().to_pybytes(), shingle, seed) for x in b.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, fp long")


def _star(members: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(smallest, other) for each linked group of distinct fingerprints."""
    out, rest = [], members
    while len(rest) > 1:
        group, todo, rest = [rest[0]], [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= bits
            if near.any():
                found = rest[near]
                group.extend(found)
                todo.extend(found)
                rest = rest[~near]
        if len(group) > 1:
            root = min(group)
            out += [(root, x) for x in group if x != root]
    return out


def _tree(members: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Pairs that span each linked group of distinct fingerprints, each pair itself linked."""
    out, rest = [], np.sort(members)
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= bits
            if near.any():
                found = rest[near]
                out += [(min(at, x), max(at, x)) for x in found]
                todo.extend(found)
                rest = rest[~near]
    return out


def _lists(bits: int, hot_list: int | None, links=_star):
    """Links within posting lists (key, fp), as stars or trees. A list of more than ``hot_list`` members only passes them on."""

    def stars(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.r_[0, edge], np.r_[edge, len(keys)]
        sizes = ends - starts
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1]
        ok = np.bitwise_count(a ^ b) <= bits
        roots, others = [np.minimum(a, b)[ok]], [np.maximum(a, b)[ok]]
        more = [e for s, n in zip(starts[sizes > 2], sizes[sizes > 2]) for e in links(fps[s : s + n], bits)]
        if more:
            pairs = np.array(more, np.uint64)
            roots.append(pairs[:, 0])
            others.append(pairs[:, 1])
        return np.concatenate(roots), np.concatenate(others)

    def out(a: np.ndarray, b: np.ndarray, key: np.ndarray, hot: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(key), pa.array(np.full(len(a), hot))], ["a", "b", "key", "hot"])

    def passed_on(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        return out(fps, fps, keys, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a list may span batches."""
        keys, fps, long = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if long is not None:
                same = int(np.searchsorted(keys, long, "right"))
                yield passed_on(keys[:same], fps[:same])
                keys, fps, long = keys[same:], fps[same:], long if same == len(keys) else None
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys, keys[-1], "left"))
            if cut:
                yield from whole(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
            if hot_list is not None and len(keys) > hot_list:
                long = keys[-1]
                yield passed_on(keys, fps)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from whole(keys, fps)

    def whole(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.diff(keys)) + 1
        sizes = np.diff(np.r_[0, edge, len(keys)])
        if hot_list is not None and sizes.max() > hot_list:
            over = np.repeat(sizes > hot_list, sizes)
            yield passed_on(keys[over], fps[over])
            keys, fps = keys[~over], fps[~over]
        if len(keys):
            a, b = stars(keys, fps)
            if len(a):
                yield out(a, b, np.zeros(len(a), np.int64), False)

    return run


def _finer(bits: int):
    """From members of lists (fp, key) to entries (key, fp) of their finer lists: the key named one choice of bytes, and now
    names one choice of half of the other bytes' halves as well."""
    choices = list(combinations(range(8), 8 - bits))
    finer = list(combinations(range(2 * bits), bits))
    half, word = np.uint64(15), np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, key = (batch.column(k).to_numpy(zero_copy_only=False).view(word) for k in range(2))
            chosen = (key >> word(8 * (8 - bits))).astype(np.int64)
            for n in np.unique(chosen):
                mine, base = fp[chosen == n], key[chosen == n]
                halves = [(mine >> word(8 * p + 4 * k)) & half for p in range(8) if p not in choices[n] for k in range(2)]
                for m, picked in enumerate(finer):
                    part = base * word(len(finer)) + word(m)
                    for k in picked:
                        part = (part << word(4)) | halves[k]
                    yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(mine.view(np.int64))], ["key", "fp"])

    return run


def _posting(fps: DataFrame, shared: int) -> DataFrame:
    """(key, fp): an entry for every choice of ``shared`` positional bytes. Two fingerprints meet in a list of such entries just
    when their tally of equal positional bytes reaches ``shared``."""
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = []
    for n, chosen in enumerate(combinations(range(8), shared)):
        key = F.lit(n).cast("long")
        for p in chosen:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fps.repartition(n, "fp").select(F.explode(F.array(*keys)).alias("key"), "fp")  # a few files of fingerprints make many entries


def near_fingerprints(fps: DataFrame, bits: int, shared: int, hot_list: int = HOT_LIST, scratch: Scratch | None = None) -> DataFrame:
    """Pairs (a, b) of at most ``bits`` differing bits and at least ``shared`` equal positional bytes, as many as span each linked
    group of each list; ``fps`` has distinct fp. Lists of more than ``hot_list`` members give none."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = _posting(fps, shared).repartition(n, "key").sortWithinPartitions("key")
    found = lists.mapInArrow(tidy(_lists(bits, hot_list, _tree)), "a long, b long, key long, hot boolean").where("not hot").select("a", "b")
    return (scratch or Scratch()).written(found.distinct(), "simhash-pairs")


def linked_fingerprints(fps: DataFrame, bits: int = BITS, hot_list: int = HOT_LIST, scratch: Scratch | None = None) -> DataFrame:
    """Edges (a, b) that connect just what links of at most ``bits`` differing bits connect; ``fps`` has distinct fp."""
    if not 0 < bits <= 4:
        raise ValueError("bits must be from 1 to 4")
    scratch = scratch or Scratch()
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posting = _posting(fps, 8 - bits)

    def links(entries: DataFrame, most: int | None) -> DataFrame:
        lists = entries.repartition(n, "key").sortWithinPartitions("key")
        return scratch.written(lists.mapInArrow(_lists(bits, most), "a long, b long, key long, hot boolean").distinct(), "simhash-links")

    found = links(posting, hot_list)
    hot = found.where("hot").select("a", "key")
    edges = found.where("not hot").select("a", "b")
    if hot.isEmpty():
        return edges
    return edges.unionByName(links(hot.mapInArrow(_finer(bits), "key long, fp long"), None).select("a", "b"))


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) for every node of the edges (a, b): alternating large-star and small-star rounds, each written, until every
    node hangs on one root that hangs on none."""
    scratch = scratch or Scratch()

    def star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))  # large: every neighbour above goes to the least
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        down = large.groupBy("b").agg(F.min("a").alias("m"))  # small: all below go to the least of them
        return large.join(down, "b").select(F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b")).distinct()

    def done(e: DataFrame) -> bool:
        twice = e.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select(F.col("b").alias("a"))
        return twice.unionByName(e.select("a").distinct().join(e.select(F.col("b").alias("a")), "a", "left_semi")).isEmpty()

    now = scratch.written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not done(now):
        was, now = now, scratch.written(star(now), "edges")
        scratch.drop(was)
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED, hot_list: int = HOT_LIST) -> DataFrame:
    """(id, fp, component): component is the smallest id reachable over links, one row for each row of ``df``."""
    scratch = Scratch()
    own = scratch.written(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    distinct = scratch.written(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(linked_fingerprints(distinct.select("fp"), bits, hot_list, scratch), scratch).withColumnRenamed("node", "fp")
    # Only linked fingerprints go on to the second step; the others are components of their own.
    linked = distinct.join(roots.unionByName(roots.select(F.col("root").alias("fp"), "root").distinct()), "fp")
    linked = scratch.written(linked, "linked")
    scratch.keep(own, distinct, linked)
    named = linked.groupBy("root").agg(F.min("least").alias("component"))
    of = linked.join(named, "root").select("fp", "component")
    each = distinct.join(of, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return own.join(each, "fp").select("id", "fp", "component")


def one_of_each_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of ``df`` for each component: that of the least id, null last. Rows are told apart by a 64-bit hash of id and
    text, so that rows of one id in unlike components all stay; rows alike in both are copies of each other."""
    (key,) = free_names(df, "__row")
    row = F.xxhash64(F.col(id_col), text_of(text_col))
    named = df.select(F.struct(F.col(id_col).isNull().alias("u"), F.col(id_col).alias("id"), row.alias("row")).alias("id"), F.col(text_col).alias("text"))
    groups = simhash_components(named, "id", "text", **how)
    stay = written(groups.where("id = component").groupBy(F.col("id.row").alias(key)).agg(F.count("*").alias("n")), "stay")
    own = df.withColumn(key, row)
    out = own.join(stay.where("n = 1").select(key).hint("merge"), key, "left_semi")
    if not stay.where("n > 1").isEmpty():
        out = out.unionByName(own.join(stay.where("n > 1").select(key), key, "left_semi").dropDuplicates([key]))
    return out.select(*df.columns)
