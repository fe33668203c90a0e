"""Joins between steps, tasks, cameras and keys, and set operations."""

from pyspark.sql import functions as F

from loomstep.operators import lookups as L
from loomstep.operators import mixture as M
from loomstep.plans.registry import query, table
from loomstep.sources.episodes import with_language


@query("J01_task_text", "SELECT c_custkey, n_name AS task FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def task_text(spark, sf_dir):
    tasks = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("task_index"), F.col("n_name").alias("task"))
    return table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "task_index").join(tasks, "task_index", "left").select("c_custkey", "task")


_KEYS = "(VALUES ('action.arm', 6), ('action.hand', 4), ('action.base', 3), ('action.lift', 1)) AS a(key, dim)"
_STATES = "(VALUES ('state.arm', 6), ('state.fingers', 4), ('state.base', 2)) AS s(state_key, state_dim)"


@query("J02_action_state_pairs", f"SELECT key, coalesce(m, replace(key, 'action.', 'state.')) AS state_key, coalesce(dim = state_dim, false) AS usable FROM {_KEYS} LEFT JOIN (VALUES ('action.hand', 'state.fingers')) AS x(k, m) ON k = key LEFT JOIN {_STATES} ON s.state_key = coalesce(m, replace(key, 'action.', 'state.'))")
def action_state_pairs(spark, sf_dir):
    actions = spark.createDataFrame([("action.arm", 6), ("action.hand", 4), ("action.base", 3), ("action.lift", 1)], "key string, dim int")
    states = spark.createDataFrame([("state.arm", 6), ("state.fingers", 4), ("state.base", 2)], "key string, dim int")
    mapping = spark.createDataFrame([("action.hand", "state.fingers")], "key string, state_key string")
    return L.pair_action_state(actions, states, mapping).select("key", "state_key", "usable")


@query("J04_robot_tags", "SELECT p_partkey, coalesce(CASE WHEN p_brand = 'Brand#2' THEN 'override' END, lower(p_type), 'new_embodiment') AS tag FROM part")
def robot_tags(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    over = F.broadcast(spark.createDataFrame([("Brand#2", "override")], "p_brand string, tag string"))
    return p.join(over, "p_brand", "left").select("p_partkey", F.coalesce("tag", F.lower("p_type"), F.lit("new_embodiment")).alias("tag"))


_TS = "(epoch_us(ts) / 1000000.0)::DOUBLE"
_FRAMES = f"(SELECT user_id, event_id AS frame, {_TS} AS ft FROM events WHERE event_type = 'view')"
_ASKED = f"(SELECT user_id, event_id, {_TS} AS t FROM events WHERE event_type <> 'view')"


def _seconds(df):
    return df.withColumn("sec", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


@query("J05_nearest_frame", f"SELECT event_id, arg_min(frame, (abs(t - ft), ft)) AS nearest FROM {_ASKED} JOIN {_FRAMES} USING (user_id) GROUP BY 1")
def nearest_frame(spark, sf_dir):
    e = _seconds(table(spark, sf_dir, "events"))
    frames = e.where("event_type = 'view'").select("user_id", F.col("sec").alias("ft"), F.col("event_id").alias("frame"))
    asked = e.where("event_type <> 'view'").select("user_id", "event_id", F.col("sec").alias("t"))
    return L.nearest(asked, frames, ["user_id"], "t", "ft", "frame").where("nearest is not null").select("event_id", "nearest")


@query("J06_shifted_timestamps", "SELECT event_id, round(epoch_us(ts) / 1000000.0::DOUBLE + coalesce(CASE WHEN user_id % 2 = 0 THEN user_id * 1.5::DOUBLE END, 0), 3) AS shifted FROM events")
def shifted_timestamps(spark, sf_dir):
    e = _seconds(table(spark, sf_dir, "events"))
    start = F.coalesce(F.when(F.col("user_id") % 2 == 0, F.col("user_id") * 1.5), F.lit(0.0))
    return e.select("event_id", F.round(F.col("sec") + start, 3).alias("shifted"))


@query("J07_task_categories", "SELECT r_name AS category, count(*) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def task_categories(spark, sf_dir):
    ids = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("category"))
    return table(spark, sf_dir, "customer").join(ids, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("category").agg(F.count("*").alias("total"))


_MEANS = "(SELECT pos, avg(v) AS mean FROM (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1)"


@query("J08_split_combined", f"SELECT key, (pos - lo)::BIGINT AS pos, round(mean, 6) + 0.0 AS mean FROM {_MEANS} JOIN (VALUES ('arm', 0, 8), ('hand', 8, 14), ('rest', 14, 64)) AS k(key, lo, hi) ON pos >= lo AND pos < hi")
def split_combined(spark, sf_dir):
    from loomstep.operators.stats import explode_vector

    means = explode_vector(table(spark, sf_dir, "embeddings"), "embedding").groupBy("pos").agg(F.avg("value").alias("mean"))
    keys = spark.createDataFrame([("arm", 0, 8), ("hand", 1, 6), ("rest", 2, 50)], "key string, place int, dim int")
    return L.split_combined(means, keys).select("key", F.col("pos").cast("long").alias("pos"), (F.round("mean", 6) + 0.0).alias("mean"))


@query("J09_cycling_zip", "WITH a AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation), b AS (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS j FROM region) SELECT i AS step, n_name, r_name FROM a JOIN b ON j = i % 5")
def cycling_zip(spark, sf_dir):
    a, b = table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return L.zip_cycling(a, b, "n_nationkey", "r_regionkey").select("step", "n_name", "r_name")


@query("J10_registry_merge", "SELECT p_name AS key, arg_max(p_partkey, p_partkey) AS module FROM part GROUP BY 1")
def registry_merge(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("key"), F.col("p_partkey").alias("module"))
    return M.first_of_each(p, ["key"], [F.desc("module")])


@query("P01_slice_vector", "SELECT vec_id, round(embedding[9]::DOUBLE, 6) AS first, len(embedding[9:16])::BIGINT AS dims FROM embeddings")
def slice_vector(spark, sf_dir):
    from loomstep.functions.vectors import part

    return table(spark, sf_dir, "embeddings").withColumn("v", part(F.col("embedding"), 8, 16)).select("vec_id", F.round(F.get("v", F.lit(0)).cast("double"), 6).alias("first"), F.size("v").cast("long").alias("dims"))


@query("P02_resolve_keys", "SELECT DISTINCT 'state' AS modality, lower(p_type) || '.' || p_brand AS name FROM part")
def resolve_keys(spark, sf_dir):
    key = F.concat(F.lit("state."), F.lower("p_type"), F.lit("."), "p_brand")
    modality, name = L.resolve(key)
    return table(spark, sf_dir, "part").select(modality.alias("modality"), name.alias("name")).distinct()


@query("P03_modality_dispatch", "SELECT CASE event_type WHEN 'view' THEN 'video' WHEN 'click' THEN 'action' WHEN 'signup' THEN 'language' ELSE 'state' END AS modality, count(*) AS n FROM events GROUP BY 1")
def modality_dispatch(spark, sf_dir):
    ways = {"view": F.lit("video"), "click": F.lit("action"), "signup": F.lit("language")}
    return table(spark, sf_dir, "events").groupBy(L.dispatch(F.col("event_type"), ways, F.lit("state")).alias("modality")).agg(F.count("*").alias("n"))


@query("P05_missing_keys", "SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def missing_keys(spark, sf_dir):
    wanted = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key")).distinct()
    return L.missing_keys(wanted, table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("key")), "key")


@query("P06_skip_without_language", "SELECT o_orderkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE coalesce(CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END, '') <> ''")
def skip_without_language(spark, sf_dir):
    """Customers as episodes, orders as their steps; a customer without an instruction is left out as a whole."""
    lang = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return with_language(both.withColumn("lang", lang), ["o_custkey"], "lang").select("o_orderkey")


@query("P09_unique_index", "SELECT o_orderkey AS episode, row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders")
def unique_index(spark, sf_dir):
    """Places of episode ids; an id that occurs twice ends the query."""
    from loomstep.operators.stats import require
    from loomstep.operators.windows import place_in_order

    n = table(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("episode")).agg(F.count("*").alias("n"))
    once = require(n, F.col("n") == 1, "an episode id occurs twice")
    return place_in_order(once, "episode").select("episode", F.col("place").cast("long").alias("place"))


@query("P11_indexed_access", "SELECT l_orderkey, l_linenumber, round(l_quantity, 4) AS quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)")
def indexed_access(spark, sf_dir):
    chosen = table(spark, sf_dir, "orders").where("o_orderstatus = 'P' and o_totalprice > 400000").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(chosen, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber", F.round("l_quantity", 4).alias("quantity"))


@query("P14_exclude_listed", "SELECT c_custkey FROM customer WHERE c_name NOT IN ('Customer#000000001', 'Customer#000000007')")
def exclude_listed(spark, sf_dir):
    return L.without(table(spark, sf_dir, "customer"), "c_name", ["Customer#000000001", "Customer#000000007"]).select("c_custkey")


@query("P15_pack_sample", "SELECT c_custkey, round(c_acctbal, 2) AS balance, c_mktsegment || '/' || n_name AS lang FROM customer JOIN nation ON c_nationkey = n_nationkey")
def pack_sample(spark, sf_dir):
    both = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sample = L.pack_sample([F.array("c_acctbal"), F.array(F.lit(0.0))], lang=F.concat_ws("/", "c_mktsegment", "n_name"), tag="new_embodiment")
    return both.select("c_custkey", sample.alias("s")).select("c_custkey", F.round(F.get("s.action", F.lit(0)).cast("double"), 2).alias("balance"), "s.lang")


@query("P22_select_families", "SELECT s_suppkey, s_name FROM supplier WHERE lower(s_name) IN ('supplier#000000003', 'supplier#000000005')")
def select_families(spark, sf_dir):
    return L.select_families(table(spark, sf_dir, "supplier"), "s_name", ["SUPPLIER#000000003", "five"], {"five": "Supplier#000000005"}).select("s_suppkey", "s_name")


@query("U01_union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def union_all(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name")))


@query("U02_append_annotations", "SELECT doc_id AS id, lang, NULL::VARCHAR AS role FROM documents UNION ALL SELECT conv_id, NULL, role FROM conversations")
def append_annotations(spark, sf_dir):
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return a.unionByName(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), "role"), allowMissingColumns=True)


@query("U04_set_difference", "SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 100000")
def set_difference(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")).subtract(table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("key")))


@query("U05_set_equality", "SELECT (SELECT count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT n_nationkey FROM nation)) + (SELECT count(*) FROM (SELECT n_nationkey FROM nation EXCEPT SELECT c_nationkey FROM customer)) = 0 AS equal")
def set_equality(spark, sf_dir):
    return L.same_set(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey")


@query("U06_distinct_types", "SELECT DISTINCT p_type AS robot_type FROM part")
def distinct_types(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("robot_type")).distinct()
