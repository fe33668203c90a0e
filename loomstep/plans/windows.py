"""Chunks and other gathers inside episodes."""

from pyspark.sql import functions as F

from loomstep.functions.vectors import normalize
from loomstep.operators import windows as W
from loomstep.plans.registry import query
from loomstep.sources.stand_ins import STEPS_SQL, steps

EP, ORDER = ["episode"], ["t"]


def _columns(df, name, n, keep=("episode", "t")):
    return df.select(*keep, *[F.round(F.get(name, F.lit(i)), 6).alias(f"c{i}") for i in range(n)])


@query(
    "W00_normalized_chunks",
    f"""WITH s AS {STEPS_SQL}, m AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
n AS (SELECT s.*, CASE WHEN lo = hi THEN 0 ELSE 2 * (value - lo) / (hi - lo) - 1 END AS x FROM s JOIN m USING (event_type)),
c AS (SELECT episode, t, x, coalesce(lead(x, 1) OVER w, last_value(x) OVER a) AS x1, coalesce(lead(x, 2) OVER w, last_value(x) OVER a) AS x2, coalesce(lead(x, 3) OVER w, last_value(x) OVER a) AS x3
 FROM n WINDOW w AS (PARTITION BY episode ORDER BY t), a AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT episode, count(*) AS chunks, round(avg((x + x1 + x2 + x3) / 4), 6) AS mean_value, round(max(greatest(x, x1, x2, x3)), 6) AS max_value FROM c GROUP BY episode""",
)
def normalized_chunks(spark, sf_dir):
    """Flagship: normalise by event type, chunk four steps ahead, summarise by episode."""
    s = steps(spark, sf_dir)
    m = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    n = s.join(m, "event_type").withColumn("x", normalize(F.col("value"), "min_max", F.col("lo"), F.col("hi")))
    c = W.chunk(n, EP, ORDER, "x", range(4))
    total = F.aggregate("chunk", F.lit(0.0), lambda a, v: a + v)
    return c.groupBy("episode").agg(F.count("*").alias("chunks"), F.round(F.avg(total / 4), 6).alias("mean_value"), F.round(F.max(F.array_max("chunk")), 6).alias("max_value"))


_WINDOWS = "WINDOW w AS (PARTITION BY episode ORDER BY t), a AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def _sql(offsets, padding="first_last"):
    def one(i, k):
        moved = f"lead(value, {k}) OVER w" if k >= 0 else f"lag(value, {-k}) OVER w"
        pad = "0" if padding == "zero" else f"{'last' if k >= 0 else 'first'}_value(value) OVER a"
        return f"round(coalesce({moved}, {pad}), 6) AS c{i}"

    return f"SELECT episode, t, {', '.join(one(i, k) for i, k in enumerate(offsets))} FROM {STEPS_SQL} {_WINDOWS}"


@query("W01_chunk_first_last", _sql(range(8)))
def chunk_first_last(spark, sf_dir):
    return _columns(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", range(8)), "chunk", 8)


@query("W01_chunk_zero", _sql([-2, -1, 0, 1, 2, 3], "zero"))
def chunk_zero(spark, sf_dir):
    return _columns(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", [-2, -1, 0, 1, 2, 3], "zero"), "chunk", 6)


@query("W02_long_horizon_chunk", _sql(range(0, 50)).replace("SELECT episode, t,", "SELECT episode, t,"))
def long_horizon(spark, sf_dir):
    return _columns(W.chunk_by_position(steps(spark, sf_dir), EP, ORDER, "value", range(50)), "chunk", 50)


@query(
    "W03_clamped_gather",
    f"WITH s AS {STEPS_SQL} SELECT a.episode, a.t, b.event_id AS frame FROM s a JOIN s b ON a.episode = b.episode AND b.t = least(greatest(a.t - 3, 0), a.len - 1)",
)
def clamped_gather(spark, sf_dir):
    out = W.chunk(steps(spark, sf_dir), EP, ORDER, "event_id", [-3])
    return out.select("episode", "t", F.get("chunk", F.lit(0)).alias("frame"))


@query("W04_past_states", _sql(range(-16, 0)))
def past_states(spark, sf_dir):
    return _columns(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", range(-16, 0)), "chunk", 16)


@query("W05_shifted_targets", _sql(range(1, 31)))
def shifted_targets(spark, sf_dir):
    return _columns(W.chunk_by_position(steps(spark, sf_dir), EP, ORDER, "value", range(1, 31)), "chunk", 30)


@query(
    "W06_state_action_stride",
    f"WITH s AS {STEPS_SQL}, p AS (SELECT episode, t, lag(value, 3) OVER (PARTITION BY episode ORDER BY t) AS state, value AS action FROM s) SELECT episode, t, round(state, 6) AS state, round(action, 6) AS action FROM p WHERE t >= 3 AND t % 3 = 0",
)
def state_action_stride(spark, sf_dir):
    w = W.episode_window(EP, ORDER)
    p = steps(spark, sf_dir).select("episode", "t", F.lag("value", 3).over(w).alias("state"), F.col("value").alias("action"))
    return p.where("t >= 3 and t % 3 = 0").select("episode", "t", F.round("state", 6).alias("state"), F.round("action", 6).alias("action"))


_CHUNK4 = f"(SELECT episode, t, value AS s0, value AS c0, coalesce(lead(value, 1) OVER w, last_value(value) OVER a) AS c1, coalesce(lead(value, 2) OVER w, last_value(value) OVER a) AS c2, coalesce(lag(value, 1) OVER w, first_value(value) OVER a) AS state FROM {STEPS_SQL} {_WINDOWS})"


def _with_state(spark, sf_dir):
    out = W.chunk(steps(spark, sf_dir), EP, ORDER, "value", range(3))
    return W.chunk(out, EP, ORDER, "value", [-1], name="before").withColumn("state", F.get("before", F.lit(0)))


@query("W07_delta_chunk", f"SELECT episode, t, round(c0 - state, 6) AS c0, round(c1 - c0, 6) AS c1, round(c2 - c1, 6) AS c2 FROM (SELECT * FROM {_CHUNK4})")
def delta_chunk(spark, sf_dir):
    return _columns(_with_state(spark, sf_dir).withColumn("d", W.delta_chunk(F.col("chunk"), F.col("state"))), "d", 3)


@query("W08_relative_chunk", f"SELECT episode, t, round(c0 - state, 6) AS c0, round(c1 - state, 6) AS c1, round(c2 - state, 6) AS c2 FROM {_CHUNK4}")
def relative_chunk(spark, sf_dir):
    return _columns(_with_state(spark, sf_dir).withColumn("d", W.relative_chunk(F.col("chunk"), F.col("state"))), "d", 3)


@query("W09_delta_to_absolute", f"SELECT episode, t, round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM {_CHUNK4}")
def delta_to_absolute(spark, sf_dir):
    """There and back: deltas of chunks summed up again are the chunks."""
    out = _with_state(spark, sf_dir).withColumn("d", W.delta_chunk(F.col("chunk"), F.col("state")))
    return _columns(out.withColumn("back", W.undelta_chunk(F.col("d"), F.col("state"))), "back", 3)


@query("W10_relative_to_absolute", f"SELECT episode, t, round(c0, 6) AS c0, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM {_CHUNK4}")
def relative_to_absolute(spark, sf_dir):
    out = _with_state(spark, sf_dir).withColumn("d", W.relative_chunk(F.col("chunk"), F.col("state")))
    return _columns(out.withColumn("back", F.transform("d", lambda x: x + F.col("state"))), "back", 3)


@query("W11_prefix_offsets", "WITH e AS (SELECT user_id AS episode, count(*) AS length FROM events GROUP BY 1) SELECT episode, length, (sum(length) OVER (ORDER BY episode) - length)::BIGINT AS start FROM e")
def prefix_offsets(spark, sf_dir):
    e = steps(spark, sf_dir).groupBy("episode").agg(F.count("*").alias("length"))
    return W.running_offset(e, "length", ["episode"], "start").select("episode", "length", F.col("start").cast("long").alias("start"))


@query(
    "W12_global_index",
    f"WITH s AS {STEPS_SQL} SELECT episode, t, row_number() OVER (ORDER BY episode, t) - 1 AS global_index, dense_rank() OVER (ORDER BY episode) - 1 AS episode_number FROM s",
)
def global_index(spark, sf_dir):
    """The running index from episode offsets, so no window spans all rows."""
    s = steps(spark, sf_dir)
    e = s.groupBy("episode").agg(F.count("*").alias("length"))
    e = W.place_in_order(W.running_offset(e, "length", ["episode"], "first"), "episode", "episode_number")
    return s.join(e, "episode").select("episode", "t", (F.col("first") + F.col("t")).cast("long").alias("global_index"), F.col("episode_number").cast("long").alias("episode_number"))


@query(
    "W13_even_history",
    f"""WITH s AS {STEPS_SQL}, i AS (SELECT episode, len, unnest([0, 1, 2, 3]) AS i FROM (SELECT DISTINCT episode, len FROM s)),
p AS (SELECT episode, i, CASE WHEN i = 3 THEN len - 1 ELSE floor(i * (len - 1) / 3.0)::BIGINT END AS t FROM i)
SELECT p.episode, p.i::BIGINT AS place, s.event_id AS frame FROM p JOIN s USING (episode, t)""",
)
def even_history(spark, sf_dir):
    """Each row is asked which of the four places it stands at; no episode is gathered."""
    places = F.array(*W.even_places(F.col("len"), 4))
    mine = F.filter(F.transform(places, lambda p, i: F.when(p == F.col("t"), i)), lambda i: i.isNotNull())
    return steps(spark, sf_dir).select("episode", F.explode(mine).alias("place"), F.col("event_id").alias("frame")).withColumn("place", F.col("place").cast("long"))


@query("W14_history_offsets", _sql([-6, -4, -2]))
def strided_history(spark, sf_dir):
    return _columns(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", W.history_offsets(3, 2)), "chunk", 3)


@query(
    "W15_history_buffer",
    f"WITH s AS {STEPS_SQL} SELECT a.episode, a.t, string_agg(b.event_id::VARCHAR, ',' ORDER BY b.t) AS frames FROM s a JOIN s b ON a.episode = b.episode AND b.t BETWEEN a.t - 2 AND a.t GROUP BY 1, 2",
)
def history_buffer(spark, sf_dir):
    from loomstep.operators.ensembles import history

    out = history(steps(spark, sf_dir), EP, ORDER, "event_id", 3)
    return out.select("episode", "t", F.array_join(F.transform("history", lambda x: x.cast("string")), ",").alias("frames"))


@query("W16_take_last", f"WITH s AS {STEPS_SQL} SELECT episode, t, event_id FROM s WHERE t >= len - 5")
def take_last(spark, sf_dir):
    return steps(spark, sf_dir).where("t >= len - 5").select("episode", "t", "event_id")


@query("W18_target_tail", f"SELECT episode, t, c5 AS c0, c6 AS c1, c7 AS c2 FROM ({_sql(range(8))})")
def target_tail(spark, sf_dir):
    from loomstep.functions.vectors import tail

    return _columns(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", range(8)).withColumn("chunk", tail(F.col("chunk"), 3)), "chunk", 3)


@query(
    "W19_replan",
    f"WITH c AS ({_sql(range(4))}) SELECT a.episode, a.t, CASE a.t % 4 WHEN 0 THEN b.c0 WHEN 1 THEN b.c1 WHEN 2 THEN b.c2 ELSE b.c3 END AS action FROM c a JOIN c b ON a.episode = b.episode AND b.t = a.t - a.t % 4",
)
def replan(spark, sf_dir):
    out = W.replan(W.chunk(steps(spark, sf_dir), EP, ORDER, "value", range(4)), EP, ORDER, "chunk", 4)
    return out.select("episode", "t", F.round("action", 6).alias("action"))


@query("P07_enumerate_bases", "SELECT user_id AS episode, unnest(range(count(*))) AS base FROM events GROUP BY user_id")
def enumerate_bases(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("user_id").alias("episode")).agg(F.count("*").alias("n"))
    return e.select("episode", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("base"))


@query("P10_complete_chunks", f"WITH s AS {STEPS_SQL} SELECT episode, t, len AS length FROM s WHERE t >= 2 AND t < len - 30")
def complete_chunks(spark, sf_dir):
    return W.complete_bases(steps(spark, sf_dir), "t", "len", [-2, *range(1, 31)]).select("episode", "t", F.col("len").alias("length"))
