"""Per-dimension statistics, their pooling and their folding."""

from pyspark.sql import functions as F

from loomstep.operators import stats as S
from loomstep.operators import windows as W
from loomstep.plans.registry import query, table
from loomstep.sources.stand_ins import CELLS_SQL, STEPS_SQL, cells, steps

STATS = ("mean", "std", "min", "max", "q01", "q99")
DESCRIBE = "avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99"
ROUNDED = ", ".join(f"round({c}, 5) AS {c}" for c in STATS)


def _rounded(df, *keys):
    return df.select(*keys, *[F.round(c, 5).alias(c) for c in STATS])


def _long(spark, sf_dir):
    return S.explode_vector(table(spark, sf_dir, "embeddings"), "embedding", ["label"])


LONG_SQL = "(SELECT label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"


@query("A01_vector_statistics", f"SELECT pos::BIGINT AS pos, {ROUNDED} FROM (SELECT pos, {DESCRIBE} FROM {LONG_SQL} GROUP BY pos)")
def vector_statistics(spark, sf_dir):
    return _rounded(S.describe(_long(spark, sf_dir)), F.col("pos").cast("long").alias("pos"))


@query("A01_column_statistics", f"SELECT tag, pos::BIGINT AS pos, {ROUNDED} FROM (SELECT tag, pos, {DESCRIBE} FROM {CELLS_SQL} GROUP BY tag, pos)")
def column_statistics(spark, sf_dir):
    return _rounded(S.describe(cells(spark, sf_dir), ["tag", "pos"]), "tag", F.col("pos").cast("long").alias("pos"))


_DELTA = f"""(SELECT k AS pos, value FROM (SELECT value - coalesce(lag(value) OVER w, value) AS d0, coalesce(lead(value, 1) OVER w, last_value(value) OVER a) - value AS d1,
 coalesce(lead(value, 2) OVER w, last_value(value) OVER a) - coalesce(lead(value, 1) OVER w, last_value(value) OVER a) AS d2 FROM {STEPS_SQL}
 WINDOW w AS (PARTITION BY episode ORDER BY t), a AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
 UNPIVOT (value FOR k IN (d0, d1, d2)))"""


def _mode_cells(spark, sf_dir, mode):
    both = W.chunk(W.chunk(steps(spark, sf_dir), ["episode"], ["t"], "value", range(3)), ["episode"], ["t"], "value", [-1], name="before")
    state = F.get("before", F.lit(0))
    cut = W.delta_chunk(F.col("chunk"), state) if mode == "delta" else W.relative_chunk(F.col("chunk"), state)
    return S.explode_vector(both.select(cut.alias("v")), "v").withColumn("pos", F.concat(F.lit("d"), F.col("pos").cast("string")))


@query("A02_delta_statistics", f"SELECT pos, {ROUNDED} FROM (SELECT pos, {DESCRIBE} FROM {_DELTA} GROUP BY pos)")
def delta_statistics(spark, sf_dir):
    return _rounded(S.describe(_mode_cells(spark, sf_dir, "delta")), "pos")


_REL = f"""(SELECT k AS pos, value FROM (SELECT value - s AS d0, c1 - s AS d1, c2 - s AS d2 FROM (SELECT value, coalesce(lag(value) OVER w, value) AS s, coalesce(lead(value, 1) OVER w, last_value(value) OVER a) AS c1,
 coalesce(lead(value, 2) OVER w, last_value(value) OVER a) AS c2 FROM {STEPS_SQL}
 WINDOW w AS (PARTITION BY episode ORDER BY t), a AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))) UNPIVOT (value FOR k IN (d0, d1, d2)))"""


@query("A03_relative_statistics", f"SELECT pos, {ROUNDED} FROM (SELECT pos, {DESCRIBE} FROM {_REL} GROUP BY pos)")
def relative_statistics(spark, sf_dir):
    return _rounded(S.describe(_mode_cells(spark, sf_dir, "rel")), "pos")


KEYS = [("arm", 0, 24), ("hand", 24, 48), ("gripper", 48, 64)]
KEYS_SQL = "(VALUES ('arm', 0, 24), ('hand', 24, 48), ('gripper', 48, 64)) AS k(key, lo, hi)"


def _modality(spark):
    return spark.createDataFrame(KEYS, "key string, start int, end int")


@query("A06_statistics_by_key", f"SELECT key, (pos - lo)::BIGINT AS pos, {ROUNDED} FROM (SELECT pos, {DESCRIBE} FROM {LONG_SQL} GROUP BY pos) JOIN {KEYS_SQL} ON pos >= lo AND pos < hi")
def statistics_by_key(spark, sf_dir):
    return _rounded(S.by_key(S.describe(_long(spark, sf_dir)), _modality(spark)), "key", F.col("pos").cast("long").alias("pos"))


_PER = f"(SELECT tag, pos, count(*) AS weight, {DESCRIBE} FROM {CELLS_SQL} GROUP BY tag, pos)"
_SHARES = f"(SELECT *, weight / sum(weight) OVER (PARTITION BY pos) AS w FROM {_PER})"


def _per(spark, sf_dir):
    c = cells(spark, sf_dir)
    return S.describe(c, ["tag", "pos"]).join(c.groupBy("tag", "pos").agg(F.count("*").alias("weight")), ["tag", "pos"])


@query(
    "A07_pooled_statistics",
    f"SELECT pos::BIGINT AS pos, {ROUNDED} FROM (SELECT pos, sum(w * mean) AS mean, sqrt(greatest(sum(w * (std * std + mean * mean)) - sum(w * mean) * sum(w * mean), 0)) AS std, min(min) AS min, max(max) AS max, min(q01) AS q01, max(q99) AS q99 FROM {_SHARES} GROUP BY pos)",
)
def pooled_statistics(spark, sf_dir):
    return _rounded(S.pooled(_per(spark, sf_dir), ["pos"]), F.col("pos").cast("long").alias("pos"))


@query("A08_weighted_percentiles", f"SELECT pos::BIGINT AS pos, round(sum(w * q01), 5) AS q01, round(sum(w * q99), 5) AS q99 FROM {_SHARES} GROUP BY pos")
def weighted_percentiles(spark, sf_dir):
    return S.pooled(_per(spark, sf_dir), ["pos"], percentiles="weighted_average").select(F.col("pos").cast("long").alias("pos"), F.round("q01", 5).alias("q01"), F.round("q99", 5).alias("q99"))


@query("A09_equal_configs", "SELECT c_mktsegment AS tag, count(*) AS datasets, count(DISTINCT c_nationkey) = 1 AS mergeable FROM customer GROUP BY 1")
def equal_configs(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("tag")).agg(F.count("*").alias("datasets"), (F.countDistinct("c_nationkey") == 1).alias("mergeable"))


@query(
    "A10_normalize_by_tag",
    f"WITH c AS {CELLS_SQL}, m AS (SELECT tag, pos, avg(value) AS mean, stddev_pop(value) AS std FROM c GROUP BY 1, 2) SELECT tag, pos::BIGINT AS pos, count(*) AS n, round(avg((value - mean) / std), 4) + 0.0 AS mean, round(avg(((value - mean) / std) ** 2), 4) AS square FROM c JOIN m USING (tag, pos) GROUP BY 1, 2",
)
def normalize_by_tag(spark, sf_dir):
    from loomstep.functions.vectors import normalize

    c = cells(spark, sf_dir)
    m = c.groupBy("tag", "pos").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    x = c.join(m, ["tag", "pos"]).withColumn("x", normalize(F.col("value"), "mean_std", F.col("mean"), F.col("std")))
    return x.groupBy("tag", F.col("pos").cast("long").alias("pos")).agg(F.count("*").alias("n"), (F.round(F.avg("x"), 4) + 0.0).alias("mean"), F.round(F.avg(F.col("x") * F.col("x")), 4).alias("square"))


@query(
    "A12_folded_statistics",
    f"SELECT key, string_agg(printf('%.4f', round(mean, 4) + 0.0), ' ' ORDER BY pos) AS mean, count(*) AS dims FROM (SELECT key, pos - lo AS pos, mean FROM (SELECT pos, avg(value) AS mean FROM {LONG_SQL} GROUP BY pos) JOIN {KEYS_SQL} ON pos >= lo AND pos < hi) GROUP BY key",
)
def folded_statistics(spark, sf_dir):
    got = S.fold(S.by_key(S.describe(_long(spark, sf_dir)), _modality(spark)), ["key"], ["mean"])
    return got.select("key", F.array_join(F.transform("mean", lambda m: F.format_string("%.4f", F.round(m, 4) + 0.0)), " ").alias("mean"), F.size("mean").cast("long").alias("dims"))


_MODES = "(SELECT p_partkey, p_brand AS key, CASE WHEN p_size % 7 = 0 THEN 'binary' WHEN p_size % 2 = 0 THEN 'q99' ELSE 'min_max' END AS mode FROM part)"


def _modes(spark, sf_dir):
    mode = F.when(F.col("p_size") % 7 == 0, "binary").when(F.col("p_size") % 2 == 0, "q99").otherwise("min_max")
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("key"), mode.alias("mode"))


@query("A13_action_mask", f"SELECT mode, mode <> 'binary' AS mask, count(*) AS n FROM {_MODES} GROUP BY 1")
def action_mask(spark, sf_dir):
    return _modes(spark, sf_dir).groupBy("mode", S.action_mask(F.col("mode")).alias("mask")).agg(F.count("*").alias("n"))


@query("A14_binary_wins", f"SELECT key, CASE WHEN bool_or(mode = 'binary') THEN 'binary' ELSE min(mode) END AS mode FROM {_MODES} GROUP BY 1")
def binary_wins(spark, sf_dir):
    return _modes(spark, sf_dir).groupBy("key").agg(F.when(F.bool_or(F.col("mode") == "binary"), "binary").otherwise(F.min("mode")).alias("mode"))


@query("A15_used_keys", "SELECT DISTINCT regexp_replace('action.' || p_type, '^[a-z]+\\.', '') AS key FROM part")
def used_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.regexp_replace(F.concat(F.lit("action."), "p_type"), r"^[a-z]+\.", "").alias("key")).distinct()


@query("A16_counts_by_tag", "SELECT o_orderpriority AS tag, sum(n)::BIGINT AS transitions, count(*) AS trajectories FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1")
def counts_by_tag(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    both = table(spark, sf_dir, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"))
    return both.groupBy(F.col("o_orderpriority").alias("tag")).agg(F.sum("n").alias("transitions"), F.count("*").alias("trajectories"))


@query("A29_reward_aggregates", "SELECT user_id AS episode, round(max(value), 5) AS most, round(min(value), 5) AS least, round(avg(value), 5) AS mean, round(sum(value), 4) AS total FROM events GROUP BY 1")
def reward_aggregates(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("episode"))
    return e.agg(F.round(F.max("value"), 5).alias("most"), F.round(F.min("value"), 5).alias("least"), F.round(F.avg("value"), 5).alias("mean"), F.round(F.sum("value"), 4).alias("total"))


@query("A37_status_counts", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark, sf_dir):
    return S.histogram_of_status(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status")), "status")


@query("A38_prediction_error", "SELECT l_returnflag AS tag, round(sqrt(sum((l_tax - l_discount) ** 2)) / count(*), 8) AS error FROM lineitem GROUP BY 1")
def prediction_error(spark, sf_dir):
    out = S.frobenius_error(table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "tag"), "l_tax", "l_discount", ["tag"])
    return out.select("tag", F.round("error", 8).alias("error"))


@query("N10_masked_l1", "SELECT l_linestatus AS tag, round(sum(abs(l_tax - l_discount) * (l_quantity > 25)::INT) / sum((l_quantity > 25)::INT), 8) AS loss FROM lineitem GROUP BY 1")
def masked_l1(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").withColumn("mask", F.col("l_quantity") > 25).withColumnRenamed("l_linestatus", "tag")
    return S.require(S.masked_l1(x, "l_tax", "l_discount", "mask", ["tag"]), F.col("loss").isNotNull(), "a mask is empty").select("tag", F.round("loss", 8).alias("loss"))


@query(
    "N11_group_weighted_loss",
    """WITH c AS (SELECT l_orderkey AS sample, dim, avg(e) AS per FROM (SELECT l_orderkey, 0 AS dim, (l_tax - l_discount) ** 2 AS e, l_quantity > 10 AS m FROM lineitem
UNION ALL SELECT l_orderkey, 1, abs(l_tax), l_quantity > 40 FROM lineitem) WHERE m GROUP BY 1, 2),
g AS (SELECT dim, avg(per) AS loss FROM (SELECT sample, dim, avg(per) AS per FROM c GROUP BY 1, 2) GROUP BY 1)
SELECT round(sum(CASE dim WHEN 0 THEN 500 * loss ELSE loss END), 6) AS loss, count(*) AS groups FROM g""",
)
def group_weighted_loss(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem")
    gaps = F.array(
        F.struct(F.lit(0).alias("dim"), F.pow(F.col("l_tax") - F.col("l_discount"), F.lit(2.0)).alias("e"), (F.col("l_quantity") > 10).alias("m")),
        F.struct(F.lit(1).alias("dim"), F.abs("l_tax").alias("e"), (F.col("l_quantity") > 40).alias("m")),
    )
    per = x.select("l_orderkey", F.explode(gaps).alias("g")).where("g.m").groupBy("l_orderkey", "g.dim").agg(F.avg("g.e").alias("per"))
    by = per.groupBy("dim").agg(F.avg("per").alias("loss"))
    return by.agg(F.round(F.sum(F.when(F.col("dim") == 0, 500 * F.col("loss")).otherwise(F.col("loss"))), 6).alias("loss"), F.count("*").alias("groups"))


@query(
    "N15_angles",
    "WITH p AS (SELECT a.label, degrees(acos(list_cosine_similarity(a.embedding, b.embedding))) AS angle FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1) SELECT label::BIGINT AS label, round(avg(angle), 2) AS mean, round(stddev_samp(angle), 2) AS std FROM p GROUP BY 1",
)
def angles(spark, sf_dir):
    from loomstep.functions.vectors import cosine

    e = table(spark, sf_dir, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    angle = F.degrees(F.acos(cosine(F.col("embedding"), F.col("other"), 0.0)))
    return e.join(nxt, "vec_id").groupBy(F.col("label").cast("long").alias("label")).agg(F.round(F.avg(angle), 2).alias("mean"), F.round(F.stddev_samp(angle), 2).alias("std"))


@query("S30_statistics_json", f"SELECT tag, 'mean=' || string_agg(printf('%.3f', mean), ',' ORDER BY pos) || ';max=' || string_agg(printf('%.3f', max), ',' ORDER BY pos) AS body FROM (SELECT tag, pos, avg(value) AS mean, max(value) AS max FROM {CELLS_SQL} GROUP BY 1, 2) GROUP BY tag")
def statistics_json(spark, sf_dir):
    long = cells(spark, sf_dir).groupBy("tag", "pos").agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
    got = S.fold(long, ["tag"], ["mean", "max"])
    show = lambda c: F.array_join(F.transform(c, lambda v: F.format_string("%.3f", v)), ",")
    return got.select("tag", F.concat(F.lit("mean="), show("mean"), F.lit(";max="), show("max")).alias("body"))


