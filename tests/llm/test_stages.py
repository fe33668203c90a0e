"""Every stage of the pipeline against plain Python on its own input, and on rows of all kinds."""

import hashlib
import math
import re
from collections import Counter

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_near import brute_kept
from tokenizers import Tokenizer

from loomstep.llm import nbsvm
from loomstep.llm.common import held_out, labels
from loomstep.llm.queries import vocabulary

STAGES = dict(corpus_pipeline.STAGES)
SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"": now.collect()}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).cache()
        out[name] = now.collect()
    return out


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_quality(spark, sf_dir, steps):
    """Scored one by one on the driver, with the model's weights summed in plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = nbsvm.train(docs, labels(spark, sf_dir), "quality", ~held_out(F.col("doc_id"), 5, 0))
    weight = dict(zip(model.codes.tolist(), model.weights.tolist()))
    kept = set()
    for r in steps[""]:
        own = {c for _, codes in nbsvm.grams(pa.array([r["text"] or ""], pa.string())) for c in codes.tolist()}
        margin = sum(weight.get(c, 0.0) for c in own) + float(model.bias)
        p = 1 / (1 + math.exp(-max(-40, min(40, model.a * margin + model.b))))
        assert abs(p - 0.3) > 1e-4
        if p >= 0.3:
            kept.add(r["doc_id"])
    assert ids(steps["quality"]) == Counter(kept)


def test_exact_dedup(steps):
    best = {}
    for r in steps["quality"]:
        key = SPACE.sub("", r["text"] or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"] or ""), r["doc_id"]))
    assert ids(steps["exact dedup"]) == Counter(i for _, i in best.values())


def test_near_dedup(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps["exact dedup"]]
    assert sorted(str(r["doc_id"]) for r in steps["near dedup"]) == brute_kept(rows)


def test_mix(steps):
    rows = steps["near dedup"]
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in rows}
    source = Counter()
    for r in rows:
        source[r["source"]] += size[r["doc_id"]]
    names = sorted(source, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        left, open_weight = sum(source.values()) - sum(3 * source[s] for s in full), sum(w for s, w in weight.items() if s not in full)
        target = {s: 3 * source[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if target[s] > 3 * source[s] + 1e-6} - full
        if not over:
            break
        full |= over
    want = Counter()
    for r in rows:
        rate = target[r["source"]] / source[r["source"]]
        digest = hashlib.md5((r["text"] or "").encode()).hexdigest()
        u = int(hashlib.md5(f"7:{r['doc_id']}:{digest}".encode()).hexdigest()[:13], 16) / 2**52
        if n := math.floor(rate) + (u < rate - math.floor(rate)):
            want[r["doc_id"]] = n
    assert ids(steps["mix"]) == want


def test_pack(steps):
    """Every document of the mix lies in the sequences as often as it is there, each id in one piece."""
    whole = Tokenizer.from_file(vocabulary())
    text = {r["doc_id"]: r["text"] or "" for r in steps["mix"]}
    size = {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in text.items()}
    pieces = steps["pack"]
    assert Counter(r["doc_id"] for r in pieces if r["start"] == 0) == ids(steps["mix"])
    have = Counter()
    for r in pieces:
        have[r["doc_id"]] += r["length"]
    assert have == Counter({i: n * size[i] for i, n in ids(steps["mix"]).items()})
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096


def test_quality_of_edge_rows(spark, sf_dir, edge, clashing, empty):
    """Null, empty, long and repeated texts, null ids, clashing names: all are scored, and columns stay as they are."""
    out = STAGES["quality"](spark, clashing, sf_dir)
    assert out.columns == clashing.columns and out.count() <= edge.count()
    nothing = STAGES["quality"](spark, empty, sf_dir)
    assert nothing.columns == empty.columns and nothing.count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.unionByName(docs.where("doc_id < 20"))
    assert Counter(r["doc_id"] for r in STAGES["quality"](spark, twice, sf_dir).collect()) >= Counter()


def test_run_on_edge_rows(spark, edge, sf_dir):
    """All stages in a row but the classifier, which needs labels of these rows."""
    now = edge
    for name in ("exact dedup", "near dedup", "mix", "pack"):
        now = STAGES[name](spark, now, sf_dir)
    assert now.count() > 0 and now.agg(F.min("length")).first()[0] > 0
