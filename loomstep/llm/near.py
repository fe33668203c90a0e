"""Near copies by SimHash: fingerprints through the inverted index on byte positions, links verified by exact Jaccard similarity.

A row's 64-bit fingerprint is the majority of its shingles' hashes. Fingerprints meet in the index of :mod:`.simhash` when their
tally of equal positional bytes reaches ``SHARED``, and link at ``BITS`` or fewer differing bits; of the links those are kept whose
sets of shingles are as similar as asked. At a similarity of 0.8 no count of equal bytes is guaranteed (of the 293 pairs of sf0.1
from 0.8 to below 1, 231 meet within 10 bits, 45 within 4), so an exact way follows for the pairs that are still in unlike components:

Two sets of which the smaller share of common shingles reaches ``similarity`` have one in common among the first
``n - ceil(similarity n) + 1`` of each, whatever the order, if it is the same for all. A second index holds those prefixes, so no
such pair is missed. The order puts shingles that a sample finds common last, which keeps lists short; the sample decides
nothing else. Each list first meets its least member only, and then only members of lists that are still in unlike components are
compared with each other: by size, by a parity
bitmap of 2,048 bits (its differing bits are never more than the sets' differing shingles), by one of at least as many bits as
the set has members, and then exactly. That goes by rounds: a member of a list is compared with a few partners at first, and, in
the lists where that left out any in unlike components, with many more, until none is left out. Groups of similar documents grow
together in the first rounds, so that not all their pairs are ever formed, and no pair that could link two components is lost.
A list of more than ``LONG`` members is dealt into parts, and every two parts are a list of their own, so that no task holds more
than two parts, and every two members still meet. Within a list sketches are compared block by block.

Defined results: words are those of the fingerprints (ASCII lower case, ASCII white space); a text of fewer words than a shingle
is one shingle; texts without a word, and null ones, are copies of each other. Shingles are equal if their 64-bit hashes are, and
rows are told apart by a 64-bit hash of id and text; rows alike in both are copies of each other. Of a component one row stays,
whatever its ids: that of the least id, null last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices, starts_of, tidy, words
from .common import Scratch, bounded_batches, free_names, text_of
from .simhash import SEED, components, majority, near_fingerprints

SHINGLE, SIMILARITY = 5, 0.8
BITS, SHARED = 10, 2  # fingerprints that link: differing bits at most, equal positional bytes at least
SAMPLE, MOST_COMMON = 4096, 100_000  # documents looked at for the order, and shingles it may put last
SKETCH, EPSILON, BLOCK = 2048, 1e-9, 128
LONG, PAIRS = 16384, 1 << 17  # members of a list that are held at once, and of its pairs those sent on at once
FIRST, WIDER = 2, 64  # partners that a list's member is compared with in the first round; how many times more in each next one
SLICE_BYTES, U = 1 << 20, np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's shingles. Words are hashed once for a slice of texts; a shingle's hash mixes
    its words' hashes, each multiplied by a number of its place."""
    found = words(texts)
    of = np.fromiter((xxhash.xxh64_intdigest(w.encode().lower(), seed) for w in found.distinct), np.uint64, len(found.distinct))
    place = _mix(np.arange(1, shingle + 1, dtype=np.uint64)) | U(1)
    h = of[found.index]
    most = max(0, len(h) - shingle + 1)
    mixed = np.zeros(most, np.uint64)
    for k in range(shingle):
        mixed += h[k : k + most] * place[k]
    mixed = _mix(mixed)
    for at, n in zip(starts_of(found.per_doc).tolist(), found.per_doc.tolist()):
        if n >= shingle:
            yield np.unique(mixed[at : at + n - shingle + 1])
        else:
            yield _mix(np.array([n + 1], np.uint64) * place[0] + (h[at : at + n] * place[:n]).sum(dtype=np.uint64))


def sketches(own: np.ndarray) -> tuple[bytes, bytes]:
    """Parities of a set's members by their low bits: one with at least as many bits as members, and that folded to SKETCH."""
    bits = max(SKETCH, 1 << (len(own) - 1).bit_length())
    wide = np.packbits(np.bincount((own & U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")
    return _folded(wide, SKETCH // 8).tobytes(), wide.tobytes()


def _folded(wide: np.ndarray, size: int) -> np.ndarray:
    """A parity sketch as one of ``size`` bytes."""
    return np.bitwise_xor.reduce(wide.reshape(-1, size), axis=0)


def _each_text(column: pa.Array) -> Iterator[bytes]:
    return (x.as_buffer().to_pybytes() for x in column.cast(pa.binary()))


def _common(rows: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that several documents of a sample share, sorted, and how many do."""
    every = max(1, rows.count() // SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, 0, SLICE_BYTES):
                for own in shingle_sets(part.column(0), shingle):
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], ["token"])

    some = rows.where(F.pmod("row", F.lit(every)) == 0).select("text").mapInArrow(tidy(run), "token long")
    found = some.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "token").limit(MOST_COMMON).toPandas()
    token, n = found["token"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(token)
    return token[order], n[order]


def _index(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(row, id, size, fp, sketch, wide, tokens): the fingerprint and the prefix of each document."""
    known = rows.sparkSession.sparkContext.broadcast(_common(rows, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, count = known.value
        for batch in batches:
            for b in slices(batch, 2, SLICE_BYTES):
                sizes, fps, small, wide, prefixes = [], [], [], [], []
                for own in shingle_sets(b.column(2), shingle):
                    n = len(own)
                    rank = np.zeros(n, np.int64)
                    if len(token):
                        at = np.minimum(np.searchsorted(token, own), len(token) - 1)
                        rank = np.where(token[at] == own, count[at], 0)
                    sizes.append(n)
                    fps.append(majority(own))
                    for out, sketch in zip((small, wide), sketches(own)):
                        out.append(sketch)
                    prefixes.append(own[np.lexsort((own, rank))][: n - ceil(similarity * n - EPSILON) + 1].view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(small, pa.binary()), pa.array(wide, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))], ["row", "id", "size", "fp", "sketch", "wide", "tokens"])

    return rows.select("row", "id", "text").mapInArrow(tidy(run), f"row long, id {rows.schema['id'].dataType.simpleString()}, size long, fp long, sketch binary, wide binary, tokens array<long>")


def _verified(pairs: DataFrame, rows: DataFrame, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """Those of the pairs (a, b) of which the sets are as similar as asked."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 1, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in shingle_sets(b.column(1), shingle)], pa.binary())], ["row", "own"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(_each_text(b.column(2)), _each_text(b.column(3))):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(both >= similarity * (len(p) + len(q) - both) - EPSILON)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    asked = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    texts = rows.select("row", "text").join(asked, "row", "left_semi").dropDuplicates(["row"])
    own = scratch.written(texts.mapInArrow(tidy(sets), "row long, own binary"), "near-sets")
    left, right = own.select(F.col("row").alias("a"), F.col("own").alias("x")), own.select(F.col("row").alias("b"), F.col("own").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    out = scratch.written(both.mapInArrow(tidy(check), "a long, b long"), "near-links")
    scratch.drop(own)
    return out


def _able(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that size and wide sketch do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, q = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 4))
            ok = np.minimum(p, q) >= similarity * np.maximum(p, q) - EPSILON
            most = (p + q) * (1 - similarity) / (1 + similarity) + EPSILON
            for k, (x, y) in enumerate(zip(_each_text(b.column(3)), _each_text(b.column(5)))):
                if ok[k]:
                    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                    size = min(len(x), len(y))
                    ok[k] = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum()) <= most[k]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok))

    side = lambda name, size, sketch: nodes.select(F.col("row").alias(name), F.col("size").alias(size), F.col("wide").alias(sketch))
    return pairs.join(side("a", "p", "x"), "a").join(side("b", "q", "y"), "b").select("a", "b", "p", "x", "q", "y").mapInArrow(tidy(run), "a long, b long")


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(_each_text(column)), np.uint64).reshape(-1, SKETCH // 64)


def _near(x: np.ndarray, y: np.ndarray, total: np.ndarray, similarity: float) -> np.ndarray:
    """False where sketches differ in more bits than sets of ``total`` members that are as similar as asked differ in members:
    at most (1 - s) / (1 + s) of them."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= total * (1 - similarity) / (1 + similarity) + EPSILON


def _unlike(similarity: float, most: int, salt: int):
    """Of each list (rows sorted by token), pairs in unlike components that size and sketch do not rule out: all of them in lists
    where no member has more than ``most`` partners, else the first ``most`` of each, in an order that ``salt`` changes. A row
    (token, 0, true) says that some of a list were left for a later round."""

    def able(p, q, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Which of the pairs of places (p, q) may be similar."""
        x, y = sizes[p], sizes[q]
        ok = np.minimum(x, y) >= similarity * np.maximum(x, y) - EPSILON
        ok[ok] = _near(bits[p[ok]], bits[q[ok]], (x + y)[ok], similarity)
        return ok

    def within(start: int, n: int, ids: np.ndarray, roots: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(places, places, whether some were left) of a list of more than two."""
        if n <= most + 1:
            for first in range(0, n, BLOCK):
                for to in range(first, n, BLOCK):
                    i, j = start + first, start + to
                    p, q = np.nonzero(roots[i : min(i + BLOCK, start + n)][:, None] != roots[j : min(j + BLOCK, start + n)])
                    p, q = p + i, q + j
                    p, q = (p[p < q], q[p < q]) if to == first else (p, q)
                    ok = able(p, q, sizes, bits)
                    yield p[ok], q[ok], False
            return
        order = start + np.argsort(_mix(ids[start : start + n].view(U) ^ U(salt)))
        for first in range(0, n, BLOCK):
            rows = order[first : first + BLOCK]
            room = np.full(len(rows), most)
            for to in range(0, n, BLOCK):
                free = np.flatnonzero(room)
                if not len(free):
                    yield order[:0], order[:0], True
                    break
                columns = order[to : to + BLOCK]
                i, j = np.nonzero(roots[rows[free]][:, None] != roots[columns])
                ok = able(rows[free[i]], columns[j], sizes, bits)
                i, j = i[ok], j[ok]
                count = np.bincount(i, minlength=len(free))
                take = np.arange(len(i)) - np.repeat(starts_of(count), count) < room[free[i]]
                room[free] -= np.minimum(count, room[free])
                yield rows[free[i[take]]], columns[j[take]], not take.all()

    def pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1) if len(x) else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(np.zeros(both.shape[1], bool))], ["a", "b", "left"])

    def lists(token: np.ndarray, ids: np.ndarray, roots: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero(np.diff(token)) + 1
        start = np.r_[0, edge]
        n = np.diff(np.r_[start, len(token)])
        two = start[n == 2]
        two = two[roots[two] != roots[two + 1]]
        two = two[able(two, two + 1, sizes, bits)]
        p, q, held, left = [two], [two + 1], len(two), []
        for at, size in zip(start[n > 2].tolist(), n[n > 2].tolist()):
            rest = False
            for i, j, more in within(at, size, ids, roots, sizes, bits):
                p.append(i)
                q.append(j)
                held, rest = held + len(i), rest or more
                if held > PAIRS:
                    yield pairs(ids[np.concatenate(p)], ids[np.concatenate(q)])
                    p, q, held = [two[:0]], [two[:0]], 0
            if rest:
                left.append(token[at])
        yield pairs(ids[np.concatenate(p)], ids[np.concatenate(q)])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(np.zeros(len(left), np.int64)), pa.array(np.ones(len(left), bool))], ["a", "b", "left"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # batches, or the end of one, since the last list began
        for batch in batches:
            now = (*(batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)), _bits(batch.column(4)))
            if not len(now[0]):
                continue
            held.append(now)
            if held[0][0][0] != now[0][-1]:  # else one list goes on, and is put together when it ends
                own = tuple(np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(own[0], own[0][-1], "left"))
                yield from lists(*(x[:cut] for x in own))
                held = [tuple(x[cut:].copy() for x in own)]
        if held:
            yield from lists(*(np.concatenate(x) for x in zip(*held)))

    return run


def _by_fingerprint(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of rows, a < b: of equal fingerprints each with the least row, and the least rows of linked fingerprints."""
    alike = scratch.written(nodes.groupBy("fp").agg(F.min("row").alias("least")), "near-fingerprints")
    links = near_fingerprints(alike.select("fp"), BITS, SHARED, scratch=scratch)
    ends = links.join(alike.select(F.col("fp").alias("a"), F.col("least").alias("p")), "a").join(alike.select(F.col("fp").alias("b"), F.col("least").alias("q")), "b")
    same = nodes.select("row", "fp").join(alike, "fp").where("row <> least").select(F.col("least").alias("a"), F.col("row").alias("b"))
    return ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).unionByName(same)


def _rooted(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes and the roots."""
    return edges.unionByName(edges.select(F.col("root").alias("node"), "root")).distinct()


def _apart(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that are in unlike components."""
    roots = _rooted(edges)
    of = pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("p")), "a", "left").join(roots.select(F.col("node").alias("b"), F.col("root").alias("q")), "b", "left")
    return of.where(F.coalesce("p", "a") != F.coalesce("q", "b")).select("a", "b")


def _joined(edges: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components of the edges (node, root) and the links (a, b) together."""
    return components(edges.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(links), scratch)


def _dealt(lists: DataFrame) -> DataFrame:
    """(token, row, least) of lists (token, row, least, n). Those of more than LONG members are dealt into parts by their rows,
    and each member stands in the lists of its part with every part."""
    parts = F.ceil(F.col("n") / LONG)
    mine = F.pmod("row", parts)
    each = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda other: F.xxhash64(F.col("token"), F.least(mine, other), F.greatest(mine, other)))
    return lists.select(F.explode(F.when(parts == 1, F.array("token")).otherwise(each)).alias("token"), "row", "least")


def one_of_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` without those of which a near copy, or a near copy of one, stays: one row of each component."""
    bounded_batches(df.sparkSession)
    scratch = Scratch()
    row = F.xxhash64(F.col(id_col), text_of(text_col))
    rows = df.select(row.alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    index = scratch.written(_index(rows, shingle, similarity), "near-index")
    nodes = scratch.written(index.groupBy("row").agg(F.first("id").alias("id"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"), F.count("*").alias("n")), "near-nodes")
    how = (rows, shingle, similarity, scratch)
    first = scratch.written(_able(_by_fingerprint(nodes, scratch), nodes, similarity), "near-first")
    edges = components(_verified(first, *how), scratch)
    posting = index.select(F.explode("tokens").alias("token"), "row")
    lists = posting.groupBy("token").agg(F.min("row").alias("least"), F.max("row").alias("most"), F.count("*").alias("n")).where("least < most")
    shared = scratch.written(_dealt(posting.join(lists.hint("merge"), "token").select("token", "row", "least", "n").distinct()), "near-lists")
    scratch.drop(index)
    stars = shared.where("row <> least").select(F.col("least").alias("a"), F.col("row").alias("b")).distinct()
    stars = scratch.written(_able(_apart(stars, edges), nodes, similarity), "near-stars")
    edges = _joined(edges, _verified(stars, *how), scratch)
    tested, lists, most = first.unionByName(stars), shared, FIRST
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        roots = scratch.written(_rooted(edges), "near-roots")
        of = lists.join(roots.withColumnRenamed("node", "row"), "row", "left").select("token", "row", F.coalesce("root", "row").alias("root"))
        mixed = of.groupBy("token").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p <> q").select("token")
        left = of.join(mixed, "token", "left_semi").join(nodes.select("row", "size", "sketch"), "row").select("token", "row", "root", "size", "sketch")
        found = left.repartition(n, "token").sortWithinPartitions("token").mapInArrow(tidy(_unlike(similarity, most, most)), "a long, b long, left boolean")
        found = scratch.written(found.distinct(), "near-unlike")
        pairs = scratch.written(_able(found.where("not left").select("a", "b").join(tested, ["a", "b"], "left_anti"), nodes, similarity), "near-pairs")
        rest = found.where("left").select(F.col("a").alias("token"))
        if not pairs.isEmpty():
            edges = _joined(edges, _verified(pairs, *how), scratch)
        if rest.isEmpty():
            break
        tested, lists, most = tested.unionByName(pairs), shared.join(rest, "token", "left_semi"), most * WIDER
    roots = _rooted(edges)
    named = scratch.written(nodes.select(F.col("row").alias("node"), "id").join(roots, "node"), "near-groups")
    order = F.struct(F.col("id").isNull().alias("u"), F.col("id").alias("id"), F.col("node").alias("node"))
    best = named.groupBy("root").agg(F.min(order)["node"].alias("best"))
    (key,) = free_names(df, "__row")
    gone = scratch.written(named.join(best, "root").where("node <> best").select(F.col("node").alias(key)), "near-gone")
    twice = scratch.written(nodes.where("n > 1").select(F.col("row").alias(key)).join(gone, key, "left_anti"), "near-twice")
    scratch.keep(gone, twice)
    own = df.withColumn(key, row)
    if twice.isEmpty():
        return own.join(gone.hint("merge"), key, "left_anti").select(*df.columns)
    once = own.join(gone.unionByName(twice).hint("merge"), key, "left_anti")
    return once.unionByName(own.join(twice, key, "left_semi").dropDuplicates([key])).select(*df.columns)
