import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomstep.llm import bigru, crf, nbsvm, queries
from loomstep.llm.batches import words


def test_words_of_slices():
    got = words(pa.array(["a  b\ta", None, "", " \x0b ", "c d"]))
    assert [got.distinct[i] for i in got.index] == ["a", "b", "a", "c d"]
    assert got.doc.tolist() == [0, 0, 0, 4] and got.per_doc.tolist() == [3, 0, 0, 0, 1]


def test_dual_coordinate_descent_meets_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.random((40, 6)) < 0.5
    y = np.where(x[:, 0] ^ (rng.random(40) < 0.1), 1.0, -1.0)
    values = rng.normal(size=6)
    w = nbsvm.dual_coordinate_descent([np.flatnonzero(r) for r in x], values, y, np.full(40, 0.5), 400)
    full = np.c_[x * values, np.ones(40)]
    loss = lambda v: v @ v / 2 + 0.5 * np.maximum(0, 1 - y * (full @ v)).sum()
    best = loss(w)
    assert all(best <= loss(w + d) + 1e-6 for d in rng.normal(0, 0.02, (400, 7)))


def test_quality_learns_and_scores_edges(spark, edge, clashing, empty):
    good, bad = ["the cat sat on the mat and slept"] * 20, ["buy!!! now$$$ %%% ### click&&&"] * 20
    model = nbsvm.fit([f"{t} {i}" for i, t in enumerate(good + bad)], np.array([1] * 20 + [0] * 20))
    got = nbsvm.score(spark.createDataFrame([(1, "the dog sat on the mat 5"), (2, "sell!!! it$$$ %%% now 7")], "doc_id long, text string"), model)
    score = {r["id"]: r["score"] for r in got.collect()}
    assert score[1] > 0.5 > score[2]
    rows = nbsvm.score(clashing, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = nbsvm.accepted(clashing, model, 0.5)
    assert kept.columns == clashing.columns and kept.count() == sum(r["score"] >= 0.5 for r in rows)
    assert nbsvm.score(empty, model).count() == 0
    one = nbsvm.fit(["a", "b"], np.array([1, 1]))
    assert {r["score"] for r in nbsvm.score(edge, one).collect()} == {1.0}


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 4, 0, 6, 2])
    odds, step = np.exp(rng.normal(size=sizes.sum())), np.exp(rng.normal(size=(2, 2)))
    got, at = crf.forward_backward(odds, sizes, step)[0], 0
    for n in sizes:
        weight = np.zeros(n)
        total = 0.0
        for state in itertools.product((0, 1), repeat=int(n)):
            v = np.prod([odds[at + i] if s else 1.0 for i, s in enumerate(state)]) * np.prod([step[a, b] for a, b in itertools.pairwise(state)])
            total += v
            weight += v * np.array(state)
        assert got[at : at + n] == pytest.approx(weight / total)
        at += n


def test_document_score_matches_enumeration():
    """The highest of the words' probabilities, each summed over all paths; an empty text has none."""
    rng = np.random.default_rng(6)
    sizes = np.array([3, 0, 1, 7, 5])
    odds, step = np.exp(rng.normal(-2, 2, size=sizes.sum())), np.exp(rng.normal(size=(2, 2)))
    got, at = crf.highest(crf.forward_backward(odds, sizes, step)[0], sizes), 0
    for k, n in enumerate(sizes):
        paths = {s: np.prod([odds[at + i] if y else 1.0 for i, y in enumerate(s)]) * np.prod([step[a, b] for a, b in itertools.pairwise(s)]) for s in itertools.product((0, 1), repeat=int(n))}
        marginals = [sum(v for s, v in paths.items() if s[i]) / sum(paths.values()) for i in range(n)]
        assert got[k] == pytest.approx(max(marginals, default=0.0))
        at += n


def test_toxicity_with_noisy_labels():
    """A term that stands in a tenth of the clean documents as well is still learned."""
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(60)]
    text = lambda bad: " ".join([*rng.choice(plain, 15), *([bad] if bad else [])])
    texts = [text("vileword") for _ in range(60)] + [text("vileword" if i % 20 == 0 else "") for i in range(120)]
    model = crf.fit(texts, np.array([1] * 60 + [0] * 120))
    p, sizes = model.marginals(pa.array(["w1 w2 vileword w3", "w4 w5 w6"]))
    score = crf.highest(p, sizes)
    assert score[0] > 0.5 > 0.3 > score[1] and p[2] > 0.5


def test_scoring_pass_equals_the_learning_pass():
    rng = np.random.default_rng(9)
    d = bigru.Direction(*(rng.normal(0, 0.5, s).astype(np.float32) for s in ((12, 257), (8, 4), (4, 4), (3, 4))))
    seen = rng.integers(0, 257, (20, 7))
    states = np.empty((20, 4, 7), np.float32)
    d.forward(seen, states)
    assert states == pytest.approx(np.array(d.run(seen)), abs=1e-5)


def test_toxic_spans(spark, edge, clashing, empty):
    rng = np.random.default_rng(2)
    plain = [f"w{i}" for i in range(60)]
    text = lambda bad: " ".join([*rng.choice(plain, 15), *([bad] if bad else []), *rng.choice(plain, 15)])
    texts = [text(str(rng.choice(["vileword", "nastyterm"]))) for _ in range(60)] + [text("") for _ in range(120)]
    model = crf.fit(texts, np.array([1] * 60 + [0] * 120))
    rows = crf.tag(spark.createDataFrame([(1, "w1 w2 Vileword, w3"), (2, "w4 w5 w6"), (3, None), (4, "")], "doc_id long, text string"), model).collect()
    by = {r["id"]: r for r in rows}
    assert by[1]["score"] > 0.5 and by[2]["score"] < 0.3 and by[3]["score"] == by[4]["score"] == 0
    assert [(s["start"], s["end"]) for s in by[1]["spans"]] == [(6, 15)]
    assert crf.tag(clashing, model).count() == edge.count() and crf.tag(empty, model).count() == 0
    assert {r["score"] for r in crf.tag(edge, None).collect()} == {0.0}
    assert crf.fit(["a b", "c d"], np.array([0, 0])) is None


def test_gradients_of_the_network():
    rng = np.random.default_rng(3)
    d = bigru.Direction(*(rng.normal(0, 0.5, s) for s in ((9, 257), (6, 3), (3, 3), (2, 3))))
    seen = rng.integers(0, 257, (5, 4))
    outer = [rng.normal(size=(3, 4)) for _ in range(5)]
    loss = lambda: sum((s * o).sum() for s, o in zip(d.run(seen), outer))
    grads = d.learn(seen, d.run(seen, True)[1], outer)
    for own, grad in zip((d.inputs, d.gates, d.candidate), grads):
        for _ in range(20):
            at = tuple(rng.integers(0, n) for n in own.shape) if own.shape[1] < 200 else (rng.integers(0, 9), rng.choice(seen.ravel()))
            was = own[at]
            own[at] = was + 1e-5
            up = loss()
            own[at] = was - 1e-5
            down = loss()
            own[at] = was
            assert grad[at] == pytest.approx((up - down) / 2e-5, abs=2e-3)


def test_windows_hold_every_byte():
    texts = pa.array(["abc", None, "", "x" * 200, "éß"])
    rows, doc = bigru.layout(texts, 96)
    assert [bytes(rows[doc == k][rows[doc == k] != bigru.PAD].astype("u1").tolist()).decode() for k in range(5)] == ["abc", "", "", "x" * 200, "éß"]


def test_languages(spark, edge, clashing, empty):
    rng = np.random.default_rng(4)
    say = lambda letters, n: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(n))
    texts, langs = [say("abcde", 30) for _ in range(40)] + [say("vwxyz", 30) for _ in range(40)], ["aa"] * 40 + ["zz"] * 40
    model = bigru.fit(texts, langs, steps=60, batch=64)
    got = bigru.identify(spark.createDataFrame([(1, say("abcde", 200)), (2, say("vwxyz", 3)), (3, None), (4, ""), (5, "12 34 !")], "doc_id long, text string"), model).collect()
    assert [r["lang"] for r in sorted(got, key=lambda r: r["id"])] == ["aa", "zz", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert bigru.identify(clashing, model).count() == edge.count() and bigru.identify(empty, model).count() == 0
    assert {r["lang"] for r in bigru.identify(edge, bigru.fit([], [])).collect()} == {"und"}
    assert bigru.train(empty, F.lit(True)).ahead is None


@pytest.mark.parametrize("name, label, least", [("op9_nbsvm_quality", "quality", 0.9), ("op2_crf_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.QUERIES[name](spark, sf).join(marks, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.QUERIES["op10_bigru_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] >= 0.95
