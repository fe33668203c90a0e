import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from loomstep.llm import tokens
from loomstep.llm.batches import cache, tidy
from loomstep.llm.common import BATCH_BYTES, bounded_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_of_texts_are_bounded(spark, sf_dir, empty):
    """Python gets whole texts in small batches in every stage that runs it."""

    def nbytes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    row = 100_000
    docs = spark.range(200, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.lit(row)).alias("text"))
    for name, stage in corpus_pipeline.STAGES:
        if name in ("quality", "near dedup", "pack"):
            spark.conf.unset(LIMIT)
            stage(spark, empty, sf_dir)
            sizes = [r["n"] for r in docs.mapInArrow(nbytes, "n long").collect()]
            assert sum(sizes) > 200 * row and max(sizes) <= BATCH_BYTES + 2 * row, name


def test_a_smaller_bound_stays(spark):
    spark.conf.set(LIMIT, "1m")
    bounded_batches(spark)
    assert spark.conf.get(LIMIT) == "1m"
    spark.conf.unset(LIMIT)


def test_a_task_ends_without_caches_of_others():
    own = cache()
    own["a"] = 1
    assert list(tidy(lambda batches: iter([len(own), *batches]), cached=True)(iter([7]))) == [1, 7] and own
    assert list(tidy(lambda batches: iter([len(own)]))(iter([]))) == [0] and not own


def test_workers_do_not_keep_the_tokenizer(spark, edge, sf_dir):
    """Workers are used again; what packing cached in them goes with the first task of another stage."""

    def loaded(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens._loaded)])], ["n"])

    most = lambda run: edge.select("doc_id").mapInArrow(run, "n long").agg(F.max("n")).first()[0]
    corpus_pipeline.pack(spark, edge, sf_dir).count()
    assert most(loaded) == 1
    assert most(tidy(loaded)) == 0
