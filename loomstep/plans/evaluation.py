"""Success rates, pivots, chains and agreement of scores, over labels, orders and events as evaluation logs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstep.operators import evaluation as E
from loomstep.plans.registry import query, table
from loomstep.sources.stand_ins import STEPS_SQL, steps


def _flags(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    return both.withColumn("success", F.col("quality") == 1)


_FLAGS = "(SELECT doc_id, lang, source, quality = 1 AS success, toxic FROM documents JOIN labels USING (doc_id))"


@query("A18_success_by_category", f"SELECT lang AS category, count(*) AS total, sum(success::INT)::BIGINT AS successes, round(avg(success::INT), 6) AS rate FROM {_FLAGS} GROUP BY ROLLUP (lang)")
def success_by_category(spark, sf_dir):
    return E.by_category(_flags(spark, sf_dir).withColumnRenamed("lang", "category"), "category", "success").withColumn("rate", F.round("rate", 6))


@query("A19_merged_counts", f"SELECT lang AS category, count(*) AS total, sum(success::INT)::BIGINT AS successes, round(avg(success::INT), 6) AS rate FROM {_FLAGS} GROUP BY ROLLUP (lang)")
def merged_counts(spark, sf_dir):
    """From counts per file, one for each source."""
    counts = _flags(spark, sf_dir).groupBy("source", F.col("lang").alias("category")).agg(F.count("*").alias("total_count"), F.sum(F.col("success").cast("long")).alias("success_count"))
    return E.merge_counts(counts, "category").withColumn("rate", F.round("rate", 6))


@query("A20_mean_over_runs", "SELECT l_returnflag AS step, l_linestatus AS task, round(avg(l_quantity), 6) AS score FROM lineitem GROUP BY 1, 2")
def mean_over_runs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("step"), F.col("l_linestatus").alias("task")).agg(F.round(F.avg("l_quantity"), 6).alias("score"))


TYPES = ("click", "error", "purchase", "signup", "view")
_PIVOT = "SELECT user_id % 10 AS step, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES) + " FROM events GROUP BY 1"


@query("A21_pivot_scores", "SELECT step, " + ", ".join(f"round({t}, 5) AS {t}" for t in TYPES) + f" FROM ({_PIVOT})")
def pivot_scores(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("step", F.col("user_id") % 10)
    return E.pivot_mean(e, "step", "event_type", "value", TYPES).select("step", *[F.round(t, 5).alias(t) for t in TYPES])


@query("A22_row_means", f"SELECT step, round(list_avg([{', '.join(TYPES)}]), 5) AS average FROM ({_PIVOT})")
def row_means(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("step", F.col("user_id") % 10)
    return E.pivot_mean(e, "step", "event_type", "value", TYPES).select("step", F.round("average", 5).alias("average"))


@query("A23_macro_average", f"SELECT round(avg(r), 6) AS macro, count(*) AS buckets FROM (SELECT source, avg(success::INT) AS r FROM {_FLAGS} GROUP BY 1)")
def macro_average(spark, sf_dir):
    return E.macro_average(_flags(spark, sf_dir), "source", "success").withColumn("macro", F.round("macro", 6))


@query("A24_cost_report", "SELECT event_type AS suite, round(avg((value > 5)::INT), 6) AS rate, round(avg(value * 0.05), 5) AS mean_cost, round(avg((value > 5 AND value * 0.05 <= 1)::INT), 6) AS safe_rate FROM events GROUP BY 1")
def cost_report(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("suite"), (F.col("value") > 5).alias("success"), (F.col("value") * 0.05).alias("cost"))
    out = E.cost_report(e, "success", "cost", 1.0, ["suite"])
    return out.select("suite", F.round("rate", 6).alias("rate"), F.round("mean_cost", 5).alias("mean_cost"), F.round("safe_rate", 6).alias("safe_rate"))


@query("A25_episode_success", "SELECT user_id AS episode, bool_or(value > 100) AS success, count(*) AS steps FROM events GROUP BY 1")
def episode_success(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("episode"), (F.col("value") > 100).alias("success"))
    return E.episode_success(e, ["episode"], "success")


@query("A26_success_rate", f"SELECT count(*) AS num_episodes, sum(success::INT)::BIGINT AS num_successes, round(coalesce(avg(success::INT), 0), 6) AS success_rate FROM {_FLAGS}")
def success_rate(spark, sf_dir):
    return _flags(spark, sf_dir).agg(F.count("*").alias("num_episodes"), F.sum(F.col("success").cast("long")).alias("num_successes"), F.round(E.success_rate(F.col("success")), 6).alias("success_rate"))


@query("A26_no_episodes", "SELECT 0::BIGINT AS num_episodes, 0.0::DOUBLE AS success_rate")
def no_episodes(spark, sf_dir):
    return _flags(spark, sf_dir).where("doc_id < 0").agg(F.count("*").alias("num_episodes"), E.success_rate(F.col("success")).alias("success_rate"))


_CHAIN = f"(SELECT episode, coalesce(min(t) FILTER (WHERE value <= 10), max(t) + 1) AS length FROM {STEPS_SQL} WHERE t < 5 GROUP BY 1)"


def _chains(spark, sf_dir):
    s = steps(spark, sf_dir).where("t < 5").withColumn("success", F.col("value") > 10)
    return E.chain_length(s, ["episode"], "t", "success")


@query("A27_chain_length", f"SELECT episode, length FROM {_CHAIN}")
def chain_length(spark, sf_dir):
    return _chains(spark, sf_dir)


@query("A28_chain_rates", "SELECT " + ", ".join(f"round(avg((length >= {k})::INT), 6) AS rate_{k}" for k in range(1, 6)) + f", round(avg(length), 6) AS mean_length, count(*) AS sequences FROM {_CHAIN}")
def chain_rates(spark, sf_dir):
    out = E.chain_rates(_chains(spark, sf_dir))
    return out.select(*[F.round(f"rate_{k}", 6).alias(f"rate_{k}") for k in range(1, 6)], F.round("mean_length", 6).alias("mean_length"), "sequences")


@query("A30_mean_of_means", "SELECT event_type AS orientation, round(avg(m), 5) AS mean FROM (SELECT event_type, user_id % 7 AS variant, avg(value) AS m FROM events GROUP BY 1, 2) GROUP BY 1")
def mean_of_means(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("variant", F.col("user_id") % 7).withColumnRenamed("event_type", "orientation")
    return E.mean_of_means(e, ["orientation"], "variant", "value").withColumn("mean", F.round("mean", 5))


@query("A31_pearson", "SELECT l_returnflag AS tag, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def pearson(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("tag")).agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


_SCORES = "(SELECT p_brand AS policy, avg(p_retailprice) AS re, avg(p_size) AS sim FROM part GROUP BY 1)"


@query("A32_rank_violation", f"SELECT round(avg(worst), 6) AS mmrv FROM (SELECT a.policy, max(CASE WHEN (a.sim < b.sim) <> (a.re < b.re) THEN abs(a.re - b.re) ELSE 0 END) AS worst FROM {_SCORES} a JOIN {_SCORES} b ON a.policy <> b.policy GROUP BY 1)")
def rank_violation(spark, sf_dir):
    scores = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("policy")).agg(F.avg("p_retailprice").alias("re"), F.avg("p_size").alias("sim"))
    return E.mean_maximum_rank_violation(scores, "policy", "re", "sim").select(F.round("mmrv", 6).alias("mmrv"))


@query(
    "A33_kruskal",
    """WITH r AS (SELECT l_linestatus AS g, l_quantity AS v, (rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0)::DOUBLE AS r FROM lineitem), s AS (SELECT g, sum(r) AS r, count(*) AS m FROM r GROUP BY 1),
t AS (SELECT sum(n ** 3 - n) AS ties, sum(n) AS n FROM (SELECT count(*)::DOUBLE AS n FROM lineitem GROUP BY l_quantity))
SELECT round((12 / (n * (n + 1)) * (SELECT sum(r * r / m) FROM s) - 3 * (n + 1)) / (1 - ties / (n ** 3 - n)), 4) AS h, (SELECT count(*) - 1 FROM s) AS df FROM t""",
)
def kruskal(spark, sf_dir):
    return E.kruskal(table(spark, sf_dir, "lineitem"), "l_linestatus", "l_quantity").select(F.round("h", 4).alias("h"), "df")


# Log lines made from orders, read back by pattern.
_LINE = "'steps_' || (o_custkey % 9) * 1000 || '_model_infer_' || replace(lower(o_orderstatus), ' ', '') || '-v0.log.run' || o_orderkey % 3 || ' -> Average success: 0.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0')"


def _lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    text = F.concat(F.lit("steps_"), ((F.col("o_custkey") % 9) * 1000).cast("string"), F.lit("_model_infer_"), F.lower("o_orderstatus"), F.lit("-v0.log.run"), (F.col("o_orderkey") % 3).cast("string"), F.lit(" -> Average success: 0."), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))
    return o.select("o_orderkey", text.alias("value"))


@query("S22_log_lines", "SELECT (o_custkey % 9) * 1000 AS step, lower(o_orderstatus) AS task, o_orderkey % 3 AS run, round(avg((o_orderkey % 100) / 100.0::DOUBLE), 6) AS score FROM orders GROUP BY 1, 2, 3")
def log_lines(spark, sf_dir):
    from loomstep.sources.logs import parse_scores

    out = parse_scores(_lines(spark, sf_dir))
    return out.groupBy("step", "task", "run").agg(F.round(F.avg("score"), 6).alias("score"))


@query("S23_last_field", f"SELECT o_orderkey, list_last(string_split({_LINE}, ' ')) AS score FROM orders")
def last_field(spark, sf_dir):
    from loomstep.sources.logs import last_field

    return _lines(spark, sf_dir).where(F.col("value").rlike("Average success")).select("o_orderkey", last_field(F.col("value")).alias("score"))


@query("S24_last_matching_line", f"SELECT 'f' || o_orderkey % 50 AS file, arg_max({_LINE}, o_orderkey) AS value FROM orders WHERE o_orderkey % 100 <> 99 GROUP BY 1")
def last_matching_line(spark, sf_dir):
    lines = _lines(spark, sf_dir).withColumn("file", F.concat(F.lit("f"), (F.col("o_orderkey") % 50).cast("string")))
    return E.last_line(lines, r"0\.(\d[0-8]|[0-8]9)$", position="o_orderkey").select("file", "value")


@query("K02_latest_checkpoint", "SELECT o_custkey AS run, 'steps_' || max(o_orderkey) AS checkpoint FROM orders GROUP BY 1")
def latest_checkpoint(spark, sf_dir):
    names = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run"), F.concat(F.lit("steps_"), F.col("o_orderkey").cast("string")).alias("name"))
    step = F.regexp_extract("name", r"steps_(\d+)", 1).cast("long")
    return names.groupBy("run").agg(F.max_by("name", step).alias("checkpoint"))


_PROBS = "(SELECT event_id % 100 AS b, event_id, value AS p FROM events)"


@query("K04_lowest_confidence", f"SELECT b, event_id, row_number() OVER (PARTITION BY b ORDER BY p, event_id) <= 7 AS masked FROM {_PROBS}")
def lowest_confidence(spark, sf_dir):
    w = Window.partitionBy("b").orderBy("value", "event_id")
    return table(spark, sf_dir, "events").withColumn("b", F.col("event_id") % 100).select("b", "event_id", (F.row_number().over(w) <= 7).alias("masked"))


_NOISE = "(('0x' || md5('3:' || b || ':' || event_id)[1:13])::BIGINT::DOUBLE / 4503599627370496.0 * 0.999998 + 1e-6)"


@query("K05_gumbel_top_k", f"SELECT b, event_id, row_number() OVER (PARTITION BY b ORDER BY ln(p) - 4.5::DOUBLE * ln(-ln({_NOISE})), event_id) <= 7 AS masked FROM {_PROBS}")
def gumbel_top_k(spark, sf_dir):
    """k positions of each row by log-probability with noise that follows from the row and the position."""
    from loomstep.operators.mixture import hash_unit

    e = table(spark, sf_dir, "events").withColumn("b", F.col("event_id") % 100)
    noise = -F.log(-F.log(hash_unit(F.lit(3), F.col("b"), F.col("event_id")) * 0.999998 + 1e-6))
    e = e.withColumn("score", F.log("value") + 4.5 * noise)
    return e.select("b", "event_id", (F.row_number().over(Window.partitionBy("b").orderBy("score", "event_id")) <= 7).alias("masked"))


@query("K06_last_positions", "SELECT vec_id, i::BIGINT AS position FROM (SELECT vec_id, unnest(list_filter(range(64), lambda i: embedding[i + 1] > 0)[-8:]) AS i FROM embeddings)")
def last_positions(spark, sf_dir):
    from loomstep.functions.vectors import tail

    at = F.filter(F.transform("embedding", lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    return table(spark, sf_dir, "embeddings").select("vec_id", F.explode(tail(at, 8)).alias("position")).withColumn("position", F.col("position").cast("long"))


@query("K07_ordered_counts", "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def ordered_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n")).orderBy("status")


@query("K08_debug_limit", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 4")
def debug_limit(spark, sf_dir):
    return table(spark, sf_dir, "part").orderBy("p_partkey").limit(4).select("p_partkey", "p_name")
