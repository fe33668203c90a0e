"""Per-session state in its batch form; the streaming form is in :mod:`loomstep.streaming`."""

from pyspark.sql import functions as F

from loomstep.operators import ensembles as N
from loomstep.operators import evaluation as E
from loomstep.operators import windows as W
from loomstep.plans.registry import query, table
from loomstep.sources.stand_ins import STEPS_SQL, steps

# Chunks of three predictions of two values each, made at every step.
_CHUNKS = f"""(SELECT episode, t AS start, [value, c1, c2] AS a, [value * 2 - 10, c1 - 3, c2 * c2 / 50] AS b FROM (SELECT episode, t, value, coalesce(lead(value, 1) OVER w, last_value(value) OVER x) + 1 AS c1, coalesce(lead(value, 2) OVER w, last_value(value) OVER x) - 1 AS c2 FROM {STEPS_SQL}
 WINDOW w AS (PARTITION BY episode ORDER BY t), x AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)))"""


def _chunks(spark, sf_dir):
    c = W.chunk(steps(spark, sf_dir), ["episode"], ["t"], "value", range(3))
    v = [F.get("chunk", F.lit(0)), F.get("chunk", F.lit(1)) + 1, F.get("chunk", F.lit(2)) - 1]
    second = [v[0] * 2 - 10, v[1] - 3, v[2] * v[2] / 50]
    return c.select("episode", F.col("t").alias("start"), F.array(*[F.array(a, b) for a, b in zip(v, second)]).alias("chunk"))


def _ensemble_sql(alpha, every=1, horizon=3):
    return f"""WITH c AS (SELECT * FROM {_CHUNKS} WHERE start % {every} = 0), p AS (SELECT episode, start, start + i AS step, a[i + 1] AS a, b[i + 1] AS b FROM c, (SELECT unnest(range({horizon})) AS i)),
r AS (SELECT episode, step, arg_max(a, start) AS ra, arg_max(b, start) AS rb FROM p GROUP BY 1, 2),
w AS (SELECT episode, step, a, b, exp({alpha} * (a * ra + b * rb) / (sqrt(a * a + b * b) * sqrt(ra * ra + rb * rb) + 1e-7)) AS w FROM p JOIN r USING (episode, step))
SELECT episode, step, round(sum(w * a) / sum(w), 5) AS a, round(sum(w * b) / sum(w), 5) AS b FROM w GROUP BY 1, 2"""


def _wide(df):
    out = df.groupBy("episode", "step").pivot("pos", [0, 1]).agg(F.first("value"))
    return out.select("episode", "step", F.round("0", 5).alias("a"), F.round("1", 5).alias("b"))


@query("R01_adaptive_ensemble", _ensemble_sql(0.7))
def adaptive_ensemble(spark, sf_dir):
    return _wide(N.adaptive_ensemble(_chunks(spark, sf_dir), ["episode"], "start", "chunk", 0.7, 3))


@query("R02_chunked_ensemble", _ensemble_sql(0.4, every=2))
def chunked_ensemble(spark, sf_dir):
    """Chunks come every second step and expire at their end."""
    return _wide(N.adaptive_ensemble(_chunks(spark, sf_dir).where("start % 2 = 0"), ["episode"], "start", "chunk", 0.4))


@query(
    "R03_sticky_gripper",
    f"""WITH RECURSIVE s AS (SELECT episode, t, value / 100 AS o FROM {STEPS_SQL}),
r AS (SELECT episode, t, o AS ref, NULL::DOUBLE AS held, 0 AS steps, 0.0::DOUBLE AS gripper FROM s WHERE t = 0 UNION ALL
SELECT episode, t, ref, CASE WHEN steps = 15 THEN NULL ELSE held END, CASE WHEN steps = 15 THEN 0 ELSE steps END, coalesce(held, change) FROM (
 SELECT episode, t, change, CASE WHEN fresh THEN o ELSE ref END AS ref, CASE WHEN fresh THEN change ELSE held END AS held, CASE WHEN fresh OR held IS NOT NULL THEN steps + 1 ELSE steps END AS steps FROM (
  SELECT s.episode, s.t, s.o, r.ref, r.held, r.steps, r.ref - s.o AS change, r.held IS NULL AND abs(r.ref - s.o) > 0.5 AS fresh FROM r JOIN s ON s.episode = r.episode AND s.t = r.t + 1)))
SELECT episode, t, gripper + 0.0 AS gripper FROM r""",
)
def sticky_gripper(spark, sf_dir):
    s = steps(spark, sf_dir).withColumn("opening", F.col("value") / 100)
    return E.sticky_gripper(s, ["episode"], ["t"], "opening", 15).withColumn("gripper", F.col("gripper") + 0.0)


@query("R04_memoryless_gripper", "SELECT event_id, 2.0::DOUBLE * (value > 50)::INT - 1 AS gripper FROM events")
def memoryless_gripper(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", (2.0 * (F.col("value") > 50).cast("int") - 1).alias("gripper"))


@query("R05_chunk_cache", f"WITH c AS (SELECT episode, start, a FROM {_CHUNKS}) SELECT x.episode, x.start AS t, round(y.a[x.start % 3 + 1], 6) AS action FROM c x JOIN c y ON x.episode = y.episode AND y.start = x.start - x.start % 3")
def chunk_cache(spark, sf_dir):
    c = _chunks(spark, sf_dir).withColumn("firsts", F.transform("chunk", lambda v: F.get(v, F.lit(0))))
    return W.replan(c, ["episode"], ["start"], "firsts", 3).select("episode", F.col("start").alias("t"), F.round("action", 6).alias("action"))


@query("R06_task_sessions", "SELECT episode, t, sum(c) OVER (PARTITION BY episode ORDER BY t)::BIGINT AS session FROM (SELECT episode, t, coalesce((lag(event_type) OVER (PARTITION BY episode ORDER BY t) <> event_type)::INT, 0) AS c FROM " + STEPS_SQL + ")")
def task_sessions(spark, sf_dir):
    return N.sessions(steps(spark, sf_dir), ["episode"], ["t"], "event_type").select("episode", "t", "session")


@query("R07_delta_decode", f"SELECT episode, t, round(10 + sum(value) OVER (PARTITION BY episode ORDER BY t), 4) AS action FROM {STEPS_SQL}")
def delta_decode(spark, sf_dir):
    out = N.decode_actions(steps(spark, sf_dir), ["episode"], ["t"], "value", "delta", F.lit(10.0))
    return out.select("episode", "t", F.round("action", 4).alias("action"))


@query("R07_relative_decode", f"SELECT episode, t, round(10 + value, 4) AS action FROM {STEPS_SQL}")
def relative_decode(spark, sf_dir):
    out = N.decode_actions(steps(spark, sf_dir), ["episode"], ["t"], "value", "rel", F.lit(10.0))
    return out.select("episode", "t", F.round("action", 4).alias("action"))


@query("R08_history_buffer", f"SELECT episode, t, least(t + 1, 4) AS held, first_value(event_id) OVER (PARTITION BY episode ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS oldest FROM {STEPS_SQL}")
def history_buffer(spark, sf_dir):
    out = N.history(steps(spark, sf_dir), ["episode"], ["t"], "event_id", 4)
    return out.select("episode", "t", F.size("history").cast("long").alias("held"), F.get("history", F.lit(0)).alias("oldest"))


@query("R10_running_reward", f"SELECT episode, t, round(m, 5) AS running FROM (SELECT episode, t, len, max(value) OVER (PARTITION BY episode ORDER BY t) AS m FROM {STEPS_SQL}) WHERE t % 8 = 7 OR t = len - 1")
def running_reward(spark, sf_dir):
    return N.running_reward(steps(spark, sf_dir), ["episode"], ["t"], "value", 8).select("episode", "t", F.round("running", 5).alias("running"))


@query(
    "R11_observation_stack",
    f"SELECT episode, t, round(coalesce(lag(value, 2) OVER w, first_value(value) OVER w), 6) AS o0, round(coalesce(lag(value, 1) OVER w, first_value(value) OVER w), 6) AS o1, round(value, 6) AS o2 FROM {STEPS_SQL} WINDOW w AS (PARTITION BY episode ORDER BY t)",
)
def observation_stack(spark, sf_dir):
    offsets = [-2, -1, 0]
    W.check_offsets(offsets, 3)
    out = W.chunk(steps(spark, sf_dir), ["episode"], ["t"], "value", offsets)
    return out.select("episode", "t", *[F.round(F.get("chunk", F.lit(i)), 6).alias(f"o{i}") for i in range(3)])
