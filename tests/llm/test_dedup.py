import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomstep.llm import exact, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprints_and_components(edge):
    rows = edge.select("doc_id", "text").collect()
    got = simhash.simhash_components(edge).collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    want = sorted((str(r["doc_id"]), f, str(c)) for r, f, c in zip(rows, fps, brute_components([r["doc_id"] for r in rows], fps)))
    assert sorted((str(r["id"]), r["fp"] % 2**64, str(r["component"])) for r in got) == want


@pytest.mark.parametrize("hot_list", [16384, 3, 1])
def test_links_connect_what_brute_force_connects(spark, hot_list):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for seed in list(fps)[:12]:  # chains and clusters around some of them
        at = seed
        for _ in range(rng.randint(1, 25)):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                at ^= 1 << b
            fps.add(at)
            at = rng.choice([seed, at])
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = simhash.components(simhash.linked_fingerprints(df, hot_list=hot_list))
    root = {f: f for f in fps} | {r["node"] % 2**64: r["root"] % 2**64 for r in found.collect()}
    groups = lambda of: sorted(sorted(g) for g in {o: [f for f in of if of[f] == o] for o in of.values()}.values())
    want = dict(zip(fps, brute_components(fps, fps)))
    assert groups(root) == groups(want)


def test_one_of_each_component(edge, clashing, empty):
    stay = simhash.one_of_each_component(clashing)
    assert stay.columns == clashing.columns
    named = [r["id"] for r in simhash.simhash_components(edge).where("id = component").select("id").distinct().collect()]
    assert sorted(r["doc_id"] for r in stay.collect() if r["doc_id"] is not None) == sorted(named)
    assert simhash.one_of_each_component(empty).count() == 0


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r["text"] or ""), []).append(r)
    out = []
    for norm, g in groups.items():
        best = min(g, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        for r in g:
            out.append((str(r["doc_id"]), str(best["doc_id"]), len(g), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("first", [64, 2])
def test_exact_groups(edge, first):
    got = exact.exact_groups(edge, first=first).collect()
    assert sorted((str(r["id"]), str(r["keep_id"]), r["group_size"], r["sha256"]) for r in got) == brute_exact(edge.collect())
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["sha256"] for r in got}) == len({r["sha256"] for r in kept})
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_keep_first_of_copies(edge, clashing, empty):
    got = exact.keep_first_of_copies(clashing)
    assert got.columns == clashing.columns
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert sorted(norm(r["text"]) for r in got.collect()) == sorted({norm(r["text"]) for r in edge.collect()})
    unique = edge.where("doc_id is not null").dropDuplicates(["doc_id"])
    kept = {r["id"] for r in exact.exact_groups(unique).where("kept").collect()}
    assert {r["doc_id"] for r in exact.keep_first_of_copies(unique).collect()} == kept
    assert exact.keep_first_of_copies(empty).count() == 0


def test_empty_tables(empty):
    assert simhash.simhash_components(empty).count() == 0
    assert exact.exact_groups(empty).count() == 0


def test_hash_is_the_engines(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("Ünï code"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("Ünï code".encode(), 42)
