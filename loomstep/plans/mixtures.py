"""Mixture weights, deduplication, draws and quality gates."""

from pyspark.sql import functions as F

from loomstep.functions import vectors as V
from loomstep.operators import mixture as M
from loomstep.operators import windows as W
from loomstep.plans.registry import query, table
from loomstep.sources.stand_ins import STEPS_SQL, steps

# Datasets: market segments; their weights by name, their lengths by customers.
_SETS = "(SELECT c_mktsegment AS dataset, count(*) AS n, (length(c_mktsegment) % 4)::DOUBLE AS weight FROM customer GROUP BY 1)"
_SHARE = f"(SELECT *, greatest(weight * n, 1e-8) / sum(greatest(weight * n, 1e-8)) OVER () AS share FROM {_SETS})"


def _sets(spark, sf_dir):
    d = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("dataset")).agg(F.count("*").alias("n"))
    return d.withColumn("weight", (F.length("dataset") % 4).cast("double"))


@query("M01_dataset_weights", f"SELECT dataset, round(share, 8) AS share FROM {_SHARE}")
def dataset_weights(spark, sf_dir):
    return M.dataset_weights(_sets(spark, sf_dir), "weight", "n").select("dataset", F.round("share", 8).alias("share"))


@query("M01_uniform_fallback", f"SELECT dataset, round(1.0::DOUBLE / count(*) OVER (), 8) AS share FROM {_SETS}")
def uniform_fallback(spark, sf_dir):
    broken = _sets(spark, sf_dir).withColumn("weight", F.lit(float("nan")))
    return M.dataset_weights(broken, "weight", "n").select("dataset", F.round("share", 8).alias("share"))


@query(
    "M02_episode_weights",
    "WITH e AS (SELECT event_type AS dataset, user_id AS episode, count(*) AS n FROM events GROUP BY 1, 2), v AS (SELECT *, CASE WHEN n > 8 THEN n::DOUBLE ELSE 0 END AS r FROM e) SELECT dataset, episode, round(coalesce(r / nullif(sum(r) OVER (PARTITION BY dataset), 0), 0), 8) AS share FROM v",
)
def episode_weights(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("dataset"), F.col("user_id").alias("episode")).agg(F.count("*").alias("n"))
    return M.episode_weights(e, ["dataset"], "n", valid=F.col("n") > 8).select("dataset", "episode", F.round("share", 8).alias("share"))


@query("M03_primary_datasets", f"SELECT dataset, CASE WHEN bool_or(weight = 1) OVER () THEN weight = 1 ELSE weight = max(weight) OVER () END AS is_primary FROM {_SETS}")
def primary_datasets(spark, sf_dir):
    return M.primary(_sets(spark, sf_dir), "weight").select("dataset", "is_primary")


@query("A17_mixture_length", f"SELECT floor(max(n / share))::BIGINT AS epoch_length FROM (SELECT *, CASE WHEN bool_or(weight = 1) OVER () THEN weight = 1 ELSE weight = max(weight) OVER () END AS p FROM {_SHARE}) WHERE p")
def mixture_length(spark, sf_dir):
    return M.mixture_length(M.primary(M.dataset_weights(_sets(spark, sf_dir), "weight", "n"), "weight"), "n", "share")


def _unit_sql(level):
    return f"('0x' || md5('0:' || i || ':42:{level}')[1:13])::BIGINT::DOUBLE / 4503599627370496.0"


# Episodes: customers with orders; a chunk reaches two steps ahead, so an episode has two bases less than orders.
_EPISODES = "(SELECT c_mktsegment AS dataset, o_custkey AS episode, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"


def _catalogue(spark, sf_dir):
    """(datasets with share and length, episodes with share and steps)."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    e = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).groupBy(F.col("c_mktsegment").alias("dataset"), F.col("o_custkey").alias("episode")).agg(F.count("*").alias("n"))
    d = e.groupBy("dataset").agg(F.sum("n").alias("n")).withColumn("weight", (F.length("dataset") % 4).cast("double"))
    d = M.primary(M.dataset_weights(d, "weight", "n"), "weight")
    return d, M.episode_weights(e.withColumn("steps", F.col("n") - 2), ["dataset"], "n", valid=F.col("steps") > 0)


def _indices(spark, datasets):
    """An epoch's indices: as many as every primary dataset needs to be seen."""
    length = M.mixture_length(datasets, "n", "share").first()["epoch_length"] or 0
    return spark.range(length).withColumnRenamed("id", "index")


@query(
    "M04_hash_draw",
    f"""WITH e AS {_EPISODES}, s AS (SELECT dataset, sum(n)::DOUBLE AS n, (length(dataset) % 4)::DOUBLE AS weight FROM e GROUP BY 1),
w AS (SELECT *, greatest(weight * n, 1e-8) / sum(greatest(weight * n, 1e-8)) OVER () AS share, CASE WHEN bool_or(weight = 1) OVER () THEN weight = 1 ELSE weight = max(weight) OVER () END AS p FROM s),
d AS (SELECT dataset, sum(share) OVER (ORDER BY dataset) - share AS low, CASE WHEN row_number() OVER (ORDER BY dataset DESC) = 1 THEN 1.0 ELSE sum(share) OVER (ORDER BY dataset) END AS high FROM w),
f AS (SELECT dataset, episode, n - 2 AS steps, n / sum(n) OVER (PARTITION BY dataset) AS share FROM e WHERE n > 2),
r AS (SELECT dataset, episode, steps, sum(share) OVER (PARTITION BY dataset ORDER BY episode) - share AS low, CASE WHEN row_number() OVER (PARTITION BY dataset ORDER BY episode DESC) = 1 THEN 1.0 ELSE sum(share) OVER (PARTITION BY dataset ORDER BY episode) END AS high FROM f),
i AS (SELECT i, {_unit_sql(0)} AS u, {_unit_sql(1)} AS v, {_unit_sql(2)} AS x FROM (SELECT unnest(range((SELECT floor(max(n / share))::BIGINT FROM w WHERE p))) AS i))
SELECT i AS index, d.dataset, r.episode, floor(x * steps)::BIGINT AS step FROM i JOIN d ON u >= d.low AND u < d.high JOIN r ON r.dataset = d.dataset AND v >= r.low AND v < r.high""",
)
def hash_draw(spark, sf_dir):
    """Dataset, episode and step of every index of an epoch: deterministic by (epoch, index, seed), in any order and on any
    executor."""
    datasets, episodes = _catalogue(spark, sf_dir)
    return M.hierarchical_draw(_indices(spark, datasets), datasets.select("dataset", "share"), episodes, 0, 42)


@query("M04_exact_draw")
def exact_draw(spark, sf_dir):
    """The draws of numpy's generator for an epoch, batch by batch; datasets and episodes by their numbers."""
    datasets, episodes = _catalogue(spark, sf_dir)
    return M.exact_draw(_indices(spark, datasets), *M.catalogue_of(datasets, episodes), seed=42)


@query("M05_hash_seed", "SELECT event_id, right(sha256('(0, ' || event_id || ', 42)'), 32) AS seed FROM events")
def hash_seed(spark, sf_dir):
    from loomstep.functions.text import seed_128

    return table(spark, sf_dir, "events").select("event_id", seed_128(F.concat(F.lit("(0, "), F.col("event_id").cast("string"), F.lit(", 42)"))).alias("seed"))


@query("M06_gated_draw", f"WITH g AS (SELECT DISTINCT episode FROM {STEPS_SQL} WHERE event_type = 'purchase') SELECT episode, count(*) AS steps FROM {STEPS_SQL} SEMI JOIN g USING (episode) GROUP BY 1")
def gated_draw(spark, sf_dir):
    """Only episodes whose media exist are there to be drawn: a semi join before sampling, not a retry after it."""
    s = steps(spark, sf_dir)
    have = table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("episode")).distinct()
    return s.join(have, "episode", "left_semi").groupBy("episode").agg(F.count("*").alias("steps"))


@query(
    "M07_first_valid",
    "WITH c AS (SELECT event_id AS i, value < 20 AS valid FROM events), n AS (SELECT count(*) AS n FROM c), q AS (SELECT event_id AS index, unnest(range(16)) AS attempt FROM events), t AS (SELECT index, attempt, (index + attempt * 7919) % n AS candidate FROM q, n) SELECT index, coalesce(arg_min(candidate, attempt) FILTER (WHERE valid), -1) AS candidate, coalesce(min(attempt) FILTER (WHERE valid), -1) AS attempt, coalesce(bool_or(valid), false) AS resolved FROM t LEFT JOIN c ON c.i = candidate GROUP BY 1",
)
def first_valid(spark, sf_dir):
    """Every event is asked for; one whose attempts are exhausted is marked unresolved, with candidate and attempt -1."""
    e = table(spark, sf_dir, "events")
    c = e.select(F.col("event_id").alias("index"), (F.col("value") < 20).alias("valid"))
    out = M.first_valid(c.select("index"), c, e.count(), 16, unresolved=True)
    return out.select("index", F.coalesce("candidate", F.lit(-1)).alias("candidate"), F.coalesce("attempt", F.lit(-1)).cast("long").alias("attempt"), F.col("attempt").isNotNull().alias("resolved"))


@query("M08_sampling_rates", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 1.0::DOUBLE ELSE (p_partkey % 100) / 100.0::DOUBLE END AS rate FROM part")
def sampling_rates(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit("%"), (F.col("p_partkey") % 100).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", M.sampling_rate(name).alias("rate"))


_HASH = "('0x' || md5('0:' || p_partkey)[1:13])::BIGINT::DOUBLE / 4503599627370496.0"


@query("M09_exact_sample", f"SELECT p_partkey FROM part ORDER BY {_HASH}, p_partkey LIMIT (SELECT (count(*) * 0.13)::INT FROM part)")
def exact_sample(spark, sf_dir):
    return M.exact_sample(table(spark, sf_dir, "part"), "p_partkey", 0.13).select("p_partkey")


@query("K03_shuffle", f"SELECT p_partkey, row_number() OVER (ORDER BY {_HASH}, p_partkey) - 1 AS place FROM part")
def shuffle(spark, sf_dir):
    """A shuffle by hash: the order depends on the keys alone."""
    return M.shuffled(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey")


def _key_unit(*parts):
    return "('0x' || md5(" + " || ':' || ".join(parts) + ")[1:13])::BIGINT::DOUBLE / 4503599627370496.0"


_NORMAL = f"sqrt(-2 * ln(1 - {_key_unit('7', 'vec_id', 'pos', chr(39) + 'r' + chr(39))})) * cos(2 * pi() * {_key_unit('7', 'vec_id', 'pos', chr(39) + 'a' + chr(39))})"
_CELLS = "(SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings)"


@query("M10_perturbation", f"SELECT vec_id, pos::BIGINT AS pos, round(greatest(lo, least(hi, x + 0.05::DOUBLE * {_NORMAL})), 6) + 0.0 AS v FROM {_CELLS}")
def perturbation(spark, sf_dir):
    """Noise for each element, within the range of its vector."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    moved = e.select("vec_id", F.posexplode(M.perturb(F.col("v"), 0.05, F.lit(7), F.col("vec_id"))).alias("pos", "v"))
    return moved.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.round("v", 6) + 0.0).alias("v"))


@query("M11_dropout", f"SELECT vec_id, pos::BIGINT AS pos, CASE WHEN {_key_unit('7', 'vec_id')} < 0.25 THEN 0.0 ELSE round(x, 6) + 0.0 END::DOUBLE AS v FROM {_CELLS}")
def dropout(spark, sf_dir):
    """A whole vector becomes zeros with a given probability."""
    v = M.drop_out(F.col("embedding").cast("array<double>"), 0.25, F.lit(7), F.col("vec_id"))
    each = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(v).alias("pos", "v"))
    return each.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.round("v", 6) + 0.0).alias("v"))


@query("P12_skip_empty", f"SELECT dataset, n FROM {_SETS} WHERE n > 0")
def skip_empty(spark, sf_dir):
    return _sets(spark, sf_dir).where("n > 0").select("dataset", "n")


@query("P13_first_of_mixture", "SELECT p_brand AS dataset, p_type AS robot_type, min(p_partkey) AS place FROM part GROUP BY 1, 2")
def first_of_mixture(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), F.col("p_type").alias("robot_type"), F.col("p_partkey").alias("place"))
    return M.first_of_each(p, ["dataset", "robot_type"], ["place"])


@query("U03_mixture_union", "SELECT 'orders' AS dataset, 1.0::DOUBLE AS weight, o_custkey AS key FROM orders UNION ALL SELECT 'customer', 0.5::DOUBLE, c_custkey FROM customer")
def mixture_union(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.lit("orders").alias("dataset"), F.lit(1.0).alias("weight"), F.col("o_custkey").alias("key"))
    return a.unionByName(table(spark, sf_dir, "customer").select(F.lit("customer").alias("dataset"), F.lit(0.5).alias("weight"), F.col("c_custkey").alias("key")))


_CH = f"(SELECT episode, t, value AS c0, coalesce(lead(value, 1) OVER w, last_value(value) OVER a) AS c1, coalesce(lead(value, 2) OVER w, last_value(value) OVER a) AS c2 FROM {STEPS_SQL} WINDOW w AS (PARTITION BY episode ORDER BY t), a AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query("P17_fit_and_mask", f"SELECT episode, t, round(c0, 5) AS first, round(c2, 5) AS last, 2::BIGINT AS padded, 12::BIGINT AS mask_sum FROM (SELECT episode, t, c0, c2 FROM {_CH})")
def fit_and_mask(spark, sf_dir):
    """A chunk of three rows of four columns fitted to five rows of five: two rows of padding, twelve valid cells."""
    df = W.chunk(steps(spark, sf_dir), ["episode"], ["t"], "value", range(3))
    rows = df.withColumn("rows", F.transform("chunk", lambda v: F.array(v, v, v, v)))
    out = rows.where(V.all_finite(F.col("rows"))).withColumn("fit", V.fit_rows(F.col("rows"), 5, 5)).withColumn("mask", V.fit_mask(F.col("rows"), 5, 5))
    total = F.aggregate("mask", F.lit(0).cast("long"), lambda a, r: a + F.size(F.filter(r, lambda b: b)))
    return out.select("episode", "t", F.round(F.col("fit")[0][0], 5).alias("first"), F.round(F.col("fit")[4][3], 5).alias("last"), F.size(F.filter("mask", lambda r: ~F.exists(r, lambda b: b))).cast("long").alias("padded"), total.alias("mask_sum"))


@query("P18_chunk_gates", f"SELECT episode, t FROM {_CH} WHERE greatest(abs(c0), abs(c1), abs(c2)) <= 100 AND greatest(c0, c1, c2) - least(c0, c1, c2) > 0.5")
def chunk_gates(spark, sf_dir):
    """Chunks within range that move at all."""
    df = W.chunk(steps(spark, sf_dir), ["episode"], ["t"], "value", range(3))
    within = F.array_max(F.transform("chunk", F.abs)) <= 100
    return df.where(within & (F.array_max("chunk") - F.array_min("chunk") > 0.5)).select("episode", "t")


@query("P20_semantics_guard", "SELECT c_mktsegment AS mixture, count(DISTINCT c_nationkey) FILTER (WHERE c_nationkey > 5) <= 1 AS ok FROM customer GROUP BY 1")
def semantics_guard(spark, sf_dir):
    kinds = F.countDistinct(F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")))
    return table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("mixture")).agg((kinds <= 1).alias("ok"))


@query("R14_replay", "WITH n AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey) - 1 AS k FROM nation) SELECT b // 4 AS pass, b AS batch, n_nationkey FROM (SELECT unnest(range(2, 11)) AS b) JOIN n ON k // 8 = b % 4")
def replay(spark, sf_dir):
    """Nine batches, from the third on, of an endless run over 25 rows in batches of eight."""
    return M.replay(table(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey", 8, 2, 9)
