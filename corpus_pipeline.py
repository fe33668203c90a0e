"""A corpus from raw documents: quality classifier, exact dedup, near-dedup, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep.llm import exact, mixing, near, nbsvm, packing
from loomstep.llm.common import held_out, labels, written
from loomstep.llm.queries import LEAST_SCORE, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled documents that are not held out."""
    model = nbsvm.train(docs.select("doc_id", "text"), labels(spark, sf_dir), "quality", ~held_out(F.col("doc_id"), 5, 0))
    return nbsvm.accepted(docs, model, LEAST_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts but for white space, the longest original stays."""
    return exact.keep_first_of_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard of 5-word shingles of 0.8 or more), the document with the smallest id stays."""
    return near.one_of_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks; a document that is not drawn goes."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids. Each row of the mix is a document of its own."""
    return packing.pack(docs, vocabulary()).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mix", source_mix), ("pack", pack)]
#: The classifier's and the packer's rows are not SQL's to compute; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
