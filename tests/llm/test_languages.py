from pyspark.sql import functions as F

from loomstep.llm import bigru


def test_every_language_is_learned(spark):
    rows = [(i, "word " * (2 if i % 70 == 0 else 12), f"l{i % 70:02}") for i in range(210)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert bigru.train(docs, F.lit(True), per_lang=2, steps=1).langs == sorted({r[2] for r in rows})


def test_more_languages_than_states_and_repeated_ids(spark):
    """One hundred languages, one of them of short texts only; of a repeated id the least row is learned; one language alone."""
    rows = [(i, "word " * (1 if i % 100 == 3 else 12), f"l{i % 100:02}") for i in range(300)] + [(0, "other " * 20, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert bigru.train(docs, F.lit(True), per_lang=3, steps=1).langs == sorted({r[2] for r in rows[:300]})
    one = bigru.train(docs.where("lang = 'l05'"), F.lit(True))
    assert {(r["lang"], r["score"]) for r in bigru.identify(docs, one).collect()} == {("l05", 1.0)}
