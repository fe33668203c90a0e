"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bigru, crf, exact, mixing, nbsvm, packing, quality_rules, sharding, simhash, token_shards
from .common import documents, held_out, labels


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


LEAST_SCORE = 0.3  # from here a score counts as label 1


def vocabulary() -> str:
    """The tokenizer's file, which is no part of this repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _predicted(found: DataFrame, parts: int, part: int) -> DataFrame:
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id"), parts, part).alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = crf.train(docs, labels(spark, sf_dir), "toxic", ~held_out(F.col("doc_id"), 4, 2))
    return _predicted(crf.tag(docs, model).select("id", "score"), 4, 2)


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def op5_dp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return found.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.rule_report(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the shards written: each sequence's slot and place, its documents and the crc32 of its bytes."""
    found = token_shards.write_token_shards(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return found.withColumnRenamed("docs", "doc_ids")


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op9_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = nbsvm.train(docs, labels(spark, sf_dir), "quality", ~held_out(F.col("doc_id"), 5, 0))
    return _predicted(nbsvm.score(docs, model), 5, 0)


def op10_bigru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = bigru.train(docs, ~held_out(F.col("doc_id"), 5, 0))
    found = bigru.identify(docs, model)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id"), 5, 0).alias("held_out"), F.col("lang").alias("lang_pred"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_crf_toxicity": op2_crf_toxicity,
    "op3_histogram_sort": op3_histogram_sort,
    "op4_radix_dedup": op4_radix_dedup,
    "op5_dp_packing": op5_dp_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_source_mix": op8_source_mix,
    "op9_nbsvm_quality": op9_nbsvm_quality,
    "op10_bigru_language": op10_bigru_language,
}
SPACE_SQL = r"[\x20\x09-\x0D]"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{SPACE_SQL}', '', 'g') AS n FROM documents),
g AS (SELECT n, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id FROM d GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(n) AS text_sha256 FROM d JOIN g USING (n)
"""


def op6_sql(rules: tuple[quality_rules.Rule, ...] = quality_rules.RULES) -> str:
    """The base columns by other means than Spark's (windows as strings, counted and unnested), and the same rules."""
    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws.split()}))
    checks = []
    for r in rules:
        over, under = r.metric.split(" / ")
        value = f"({over}::DOUBLE / nullif({under}, 0))"
        checks += [f"coalesce({value} >= {r.least}, true)"] * (r.least is not None) + [f"coalesce({value} <= {r.most}, true)"] * (r.most is not None)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g WHERE gram IS NOT NULL),
h AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS n_marks,
  len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stop_words FROM w LEFT JOIN h USING (r)),
b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(checks)} AS kept FROM b
"""


OP8_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, row_number() OVER (PARTITION BY doc_id, coalesce(text, ''), source) - 1 AS again FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS n FROM d GROUP BY source),
w AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (SELECT a.weight * 0 + 3 * a.n / a.weight AS tight,
  ((SELECT sum(n) FROM w) - coalesce((SELECT sum(3 * b.n) FROM w b WHERE 3 * b.n / b.weight < 3 * a.n / a.weight), 0))
  / (SELECT sum(b.weight) FROM w b WHERE 3 * b.n / b.weight >= 3 * a.n / a.weight) AS level FROM w a),
v AS (SELECT level FROM l WHERE level <= tight ORDER BY tight LIMIT 1),
g AS (SELECT source AS s, n, least(3 * n, weight * (SELECT level FROM v)) AS target FROM w),
u AS (SELECT doc_id, size, n, target, target / nullif(n, 0) AS rate,
  ('0x' || md5('7:' || coalesce(doc_id::VARCHAR || ':', '') || md5(t) || CASE WHEN again > 0 THEN ':' || again ELSE '' END)[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS x
  FROM d JOIN g ON source IS NOT DISTINCT FROM s)
SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, round(target, 6) AS target,
  (size * coalesce(floor(rate) + CASE WHEN x < rate - floor(rate) THEN 1 ELSE 0 END, 0))::BIGINT AS taken FROM u
"""

ORACLES: dict[str, str] = {"op4_radix_dedup": OP4_SQL, "op6_quality_rules": op6_sql(), "op8_source_mix": OP8_SQL}
