"""Scans, path templates, prefix offsets and manifests."""

from pyspark.sql import functions as F

from loomstep.operators import windows as W
from loomstep.plans.registry import query, table
from loomstep.sources import episodes as S


@query("S01_episode_scan", "SELECT event_id, event_type, round(value, 5) AS value FROM events WHERE user_id = 7")
def episode_scan(spark, sf_dir):
    """One episode: the filter and the three columns reach the Parquet scan."""
    return table(spark, sf_dir, "events").where("user_id = 7").select("event_id", "event_type", F.round("value", 5).alias("value"))


@query("S02_shared_file_scan", "SELECT l_orderkey AS episode, count(*) AS steps FROM lineitem WHERE l_orderkey BETWEEN 100 AND 199 GROUP BY 1")
def shared_file_scan(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_orderkey between 100 and 199").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("steps"))


@query("S03_episode_lengths", "SELECT user_id AS episode_index, count(*) AS length FROM events GROUP BY 1")
def episode_lengths(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("episode_index")).agg(F.count("*").alias("length"))


@query("S04_camera_unpivot", "SELECT c_custkey AS episode, camera, v AS from_ts FROM (SELECT c_custkey, c_acctbal AS wrist, c_acctbal / 2 AS front FROM customer) UNPIVOT (v FOR camera IN (wrist, front))")
def camera_unpivot(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode"), F.col("c_acctbal").alias("videos/wrist/from_timestamp"), (F.col("c_acctbal") / 2).alias("videos/front/from_timestamp"))
    return S.unpivot_cameras(c, ["episode"], "from_timestamp").select("episode", "camera", F.col("value").alias("from_ts"))


@query("S05_task_table", "SELECT n_nationkey AS task_index, n_name AS task FROM nation")
def task_table(spark, sf_dir):
    return table(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "task_index", "n_name": "task"}).select("task_index", "task")


@query("S08_video_metadata", "SELECT event_id, coalesce((props->>'channels')::BIGINT, (props->>'k')::BIGINT, 3) AS channels FROM events")
def video_metadata(spark, sf_dir):
    get = lambda k: F.get_json_object("props", f"$.{k}").cast("long")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(get("channels"), get("k"), F.lit(3)).alias("channels"))


@query("S09_episode_chunks", "SELECT o_orderkey AS episode, o_orderkey // 1000 AS chunk FROM orders")
def episode_chunks(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), S.episode_chunk(F.col("o_orderkey"), 1000).alias("chunk"))


@query("S10_episode_files", "SELECT l.l_orderkey AS episode, count(*) AS steps, any_value(o_custkey % 10) AS file FROM lineitem l JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def episode_files(spark, sf_dir):
    meta = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), (F.col("o_custkey") % 10).alias("file"))
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("steps"))
    return n.join(meta, "episode").select("episode", "steps", "file")


@query("S11_video_paths", "SELECT o_orderkey AS episode, printf('videos/chunk-%03d/wrist/episode_%06d.mp4', coalesce(CASE WHEN o_orderstatus = 'P' THEN o_custkey % 7 END, o_orderkey // 1000)::INT, o_orderkey::INT) AS path FROM orders")
def video_paths(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    chunk = F.coalesce(F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") % 7), S.episode_chunk(F.col("o_orderkey"), 1000))
    return o.select(F.col("o_orderkey").alias("episode"), S.path_of("videos/chunk-{episode_chunk:03d}/wrist/episode_{episode_index:06d}.mp4", {"episode_chunk": chunk, "episode_index": F.col("o_orderkey")}).alias("path"))


@query("S16_frame_offsets", "WITH e AS (SELECT l_orderkey AS episode, count(*) AS n FROM lineitem GROUP BY 1) SELECT episode, (sum(n) OVER (PARTITION BY episode % 64 ORDER BY episode) - n)::BIGINT AS start FROM e")
def frame_offsets(spark, sf_dir):
    e = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).agg(F.count("*").alias("n")).withColumn("shard", F.col("episode") % 64)
    return W.running_offset(e, "n", ["episode"], "start", ["shard"]).select("episode", F.col("start").cast("long").alias("start"))


@query("S17_json_lines", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_lines(spark, sf_dir):
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


@query("S18_tagged_union", "SELECT 'conversations' AS data_path, count(*) AS n FROM conversations UNION ALL SELECT 'benchmark', count(*) FROM benchmark")
def tagged_union(spark, sf_dir):
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("data_path")) for t in ("conversations", "benchmark")]
    return parts[0].unionByName(parts[1]).groupBy("data_path").agg(F.count("*").alias("n"))


@query("S25_step_rows", "SELECT o_orderkey AS episode_index, (o_orderkey // 1000) AS chunk, round(o_totalprice, 2) AS action, row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS frame_index FROM orders")
def step_rows(spark, sf_dir):
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders").withColumn("chunk", S.episode_chunk(F.col("o_orderkey"), 1000))
    at = F.row_number().over(Window.partitionBy("chunk").orderBy("o_orderkey")) - 1
    return o.select(F.col("o_orderkey").alias("episode_index"), "chunk", F.round("o_totalprice", 2).alias("action"), at.cast("long").alias("frame_index"))


@query(
    "S37_manifest",
    "WITH m AS (SELECT p_partkey AS file, p_size AS size FROM part), h AS (SELECT l_partkey AS file, max(l_quantity)::INT AS size FROM lineitem GROUP BY 1) SELECT file, CASE WHEN h.file IS NULL THEN 'missing' WHEN h.size <> m.size THEN 'size' ELSE 'ok' END AS status FROM m LEFT JOIN h USING (file)",
)
def manifest(spark, sf_dir):
    wanted = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("file"), F.col("p_size").alias("size"))
    there = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("file")).agg(F.max("l_quantity").cast("int").alias("size"))
    return S.verify_manifest(wanted, there).select("file", "status")


@query("S38_archive_parts", "SELECT split_part(f, '.tar.part-', 1) AS archive, string_agg(split_part(f, '.tar.part-', 2), ',' ORDER BY f) AS parts FROM (SELECT p_name || '.tar.part-' || lpad((p_partkey % 5)::VARCHAR, 2, '0') AS f FROM part GROUP BY 1) GROUP BY 1")
def archive_parts(spark, sf_dir):
    f = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit(".tar.part-"), F.lpad((F.col("p_partkey") % 5).cast("string"), 2, "0")).alias("f")).distinct()
    return S.archive_parts(f, "f").select("archive", F.array_join("parts", ",").alias("parts"))
