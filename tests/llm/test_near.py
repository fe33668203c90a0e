import itertools
import random
import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loomstep.llm import near, simhash


def brute_kept(rows):
    """Rows (id, text) that stay, by comparing the shingle sets of every pair."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (x, _) in enumerate(rows):
        key = (x is None, x or 0)
        least[find(i)] = min(key, least.get(find(i), key))
    return sorted(str(None if u else x) for u, x in least.values())


def copies(seed=3, groups=25):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(800)]
    common = rng.sample(words, 12)
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(20, 150))] + common
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 9)):
            other = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 25))):
                other[rng.randrange(len(other))] = rng.choice(words)
            out.append(" ".join(other))
    rng.shuffle(out)
    return list(enumerate(out))


def kept(frame):
    return sorted(str(r["doc_id"]) for r in frame.select("doc_id").collect())


def test_stage_by_brute_force_on_shingle_sets(spark, sf_dir):
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_kept(rows)
    assert 25 <= len(want) < len(rows)
    assert kept(corpus_pipeline.near_dedup(spark, docs, sf_dir)) == want


def test_stage_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert kept(corpus_pipeline.near_dedup(spark, docs, sf_dir)) == brute_kept(rows)


def test_edge_rows(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert kept(near.one_of_near_copies(edge)) == brute_kept(rows)
    assert near.one_of_near_copies(empty).count() == 0


def test_lists_of_unlike_members(spark):
    """A and B are near copies, as are C and D; all four share a line, and neither B, C nor D is near the least one of a list."""
    rows = copies(9, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1).withColumn("doc_id", F.lit(500) - F.col("doc_id"))
    assert kept(near.one_of_near_copies(docs)) == brute_kept([(500 - i, t) for i, t in rows])
    assert kept(near.one_of_near_copies(docs, similarity=0.5)) != kept(near.one_of_near_copies(docs))


def test_repeated_ids_with_unlike_texts_stay(spark):
    rows = [(1, "a b c d e f g h i j"), (1, "k l m n o p q r s t"), (2, "a b c d e f g h i j")]
    assert kept(near.one_of_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))) == ["1", "1"]


def test_rounds_that_widen(spark, monkeypatch):
    """A dense group, about half of whose pairs are similar: one partner in the first round, two in the next, and so on."""
    monkeypatch.setattr(near, "FIRST", 1)
    monkeypatch.setattr(near, "WIDER", 2)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(500)]
    base, rows = [rng.choice(words) for _ in range(130)], []
    for i in range(40):
        other = list(base)
        for at in rng.sample(range(130), rng.randint(0, 5)):
            other[at] = rng.choice(words)
        rows.append((i, " ".join(other)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_kept(rows)
    assert 1 < len(want) < 40
    assert kept(near.one_of_near_copies(docs)) == want


def test_long_lists_are_dealt(spark, monkeypatch):
    """Every two members of a list still meet, and no list has more members than two parts."""
    monkeypatch.setattr(near, "LONG", 3)
    rows = copies(13, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert kept(near.one_of_near_copies(docs)) == brute_kept(rows)
    dealt = near._dealt(spark.createDataFrame([(7, r, 0, 40) for r in range(40)] + [(8, 1, 1, 3), (8, 2, 1, 3)], "token long, row long, least long, n long")).collect()
    lists = {}
    for r in dealt:
        lists.setdefault(r["token"], set()).add(r["row"])
    assert lists.pop(8) == {1, 2}
    assert {p for members in lists.values() for p in itertools.combinations(sorted(members), 2)} == set(itertools.combinations(range(40), 2))
    assert max(map(len, lists.values())) <= 6


def test_memory_of_a_list(monkeypatch):
    """2,000 unlike members in a round that compares each with all: about two million pairs, a few of them similar."""
    rng = np.random.default_rng(3)
    n, bits = 2000, rng.integers(0, 256, (2000, near.SKETCH // 8), np.uint8)
    bits[n // 2 : n // 2 + 20] = bits[:20]
    columns = [pa.array(np.full(n, 5)), pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array(np.full(n, 300)), pa.array([b.tobytes() for b in bits], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, ["token", "row", "root", "size", "sketch"])
    want = {(i, n // 2 + i) for i in range(20)}
    for pairs in (near.PAIRS, 3) if hasattr(near, "PAIRS") else (0,):
        monkeypatch.setattr(near, "PAIRS", pairs, raising=False)
        tracemalloc.start()
        got = [row for b in near._unlike(near.SIMILARITY, 8192, 8192)(iter([batch.slice(0, 700), batch.slice(700)])) for row in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(got) == 20 and {(r["a"], r["b"]) for r in got} == want and not any(r["left"] for r in got)
        print("peak MB", peak / 1e6)
        assert peak < 100e6


def test_fingerprints_find_pairs_first(spark, sf_dir, monkeypatch):
    """The stage gets its pairs by the index on byte positions: most near copies are in one component before prefixes are read."""
    rows = copies(17, 15)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before, apart = [], near._apart
    monkeypatch.setattr(near, "_apart", lambda pairs, edges: before.append(near._rooted(edges).collect()) or apart(pairs, edges))
    want = brute_kept(rows)
    assert kept(corpus_pipeline.near_dedup(spark, docs, sf_dir)) == want
    ((*found,),) = before
    joined = len(found) - len({r["root"] for r in found})
    assert joined >= (len(rows) - len(want)) / 2 > 0


def test_near_fingerprints_by_brute_force(spark):
    rng = random.Random(6)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for seed in list(fps):
        for _ in range(8):
            other = seed
            for b in rng.sample(range(64), rng.randint(1, 14)):
                other ^= 1 << b
            fps.add(other)
    links = {(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (a ^ b).bit_count() <= 10 and sum((a ^ b) >> 8 * p & 255 == 0 for p in range(8)) >= 2}
    df = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
    got = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.near_fingerprints(df, 10, 2).collect()}
    assert got <= links

    def groups(pairs):
        of = {f: {f} for f in fps}
        for a, b in pairs:
            of[a] |= of[b]
            for f in of[a]:
                of[f] = of[a]
        return {frozenset(g) for g in of.values()}

    assert groups(got) == groups(links) and len(groups(links)) < len(fps)
    assert simhash.near_fingerprints(df, 10, 2, hot_list=1).count() == 0
    assert simhash.majority(np.array([3, 1, 5], np.uint64)) == 1
