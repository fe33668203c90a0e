import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from loomstep.llm import exact, mixing, nbsvm, packing, simhash
from loomstep.llm.common import held_out, labels
from loomstep.llm.queries import vocabulary


def test_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps, now = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).cache()
        steps.append(now)
    assert all(s.columns == docs.columns for s in steps[:-1])
    model = nbsvm.train(docs, labels(spark, sf_dir), "quality", ~held_out(F.col("doc_id"), 5, 0))
    accepted = {r["id"] for r in nbsvm.score(docs, model).where("score >= 0.3").collect()}
    ids = [Counter(r["doc_id"] for r in s.select("doc_id").collect()) for s in steps]
    assert set(ids[1]) == accepted and set(ids[1].values()) == {1}
    best = {}
    for r in steps[1].collect():
        norm = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        best[norm] = min(best.get(norm, (1, 0)), (-len(r["text"]), r["doc_id"]))
    assert ids[2] == Counter(i for _, i in best.values())
    assert ids[3] == Counter(r["id"] for r in simhash.simhash_components(steps[2]).where("id = component").collect())
    assert ids[4] == Counter({r["id"]: r["copies"] for r in mixing.mix(steps[3]).collect() if r["copies"]})
    assert steps[5].agg(F.sum("length")).first()[0] == packing.pack(steps[4], vocabulary()).agg(F.sum("length")).first()[0]
    assert Counter(r["doc_id"] for r in steps[5].where("start = 0").collect()) == ids[4]


def test_edge_rows_go_through(spark, clashing, empty, sf_dir):
    for docs in (clashing, empty):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, sf_dir)
            if name != "pack":
                assert out.columns == docs.columns
            assert (out.count() > 0) == (docs is clashing)
    assert exact.keep_first_of_copies(empty).count() == 0
