"""Transforms bound to metadata, and position ids."""

from pyspark.sql import functions as F

from loomstep.functions import positions as P
from loomstep.operators import stats as S
from loomstep.operators import transforms as T
from loomstep.plans.registry import query, table
from loomstep.sources.episodes import Key

# Each vector as a state of three keys: an arm, a hand's rotation as an axis-angle, and a gripper.
KEYS = {k.dotted: k for k in (Key("state", "arm", "embedding", 0, 3), Key("state", "hand", "embedding", 3, 6, rotation="axis_angle"), Key("state", "gripper", "embedding", 6, 7))}
MODES = {"state.arm": "q99", "state.hand": "min_max", "state.gripper": "binary"}
_AT = "(SELECT unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"


def _metadata(spark, sf_dir):
    """Statistics of the first seven dimensions, cut by key."""
    e = table(spark, sf_dir, "embeddings").select(F.slice("embedding", 1, 7).alias("embedding"))
    rows = {r["pos"]: r for r in S.describe(S.explode_vector(e, "embedding")).collect()}  # seven rows
    names = ("mean", "std", "min", "max", "q01", "q99")
    return T.Metadata(KEYS, {name: {n: [rows[p][n] for p in range(k.start, k.end)] for n in names} for name, k in KEYS.items()}, frozenset({"state.gripper"}))


def _states(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return e.select("vec_id", *[F.slice("embedding", k.start + 1, k.end - k.start).alias(name) for name, k in KEYS.items()])


def _transform(spark, sf_dir):
    return T.StateAction(list(KEYS), MODES, {"state.hand": "quaternion"}, threshold=0.05).bind(_metadata(spark, sf_dir))


def _flat(df, *names):
    """(vec_id, key, pos, value) of vector columns."""
    cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(f"`{n}`").alias("v")) for n in names])
    out = df.select("vec_id", F.explode(cells).alias("c")).select("vec_id", "c.key", F.posexplode("c.v").alias("pos", "value"))
    return out.select("vec_id", "key", F.col("pos").cast("long").alias("pos"), (F.round("value", 5) + 0.0).alias("value"))


_BOUNDS = f"(SELECT pos, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99, min(value) AS lo, max(value) AS hi FROM {_AT} WHERE pos < 7 GROUP BY 1)"


@query("T08_bound_constants", f"SELECT 'state.arm' AS key, pos::BIGINT AS pos, round(q01, 5) AS low, round(q99, 5) AS high FROM {_BOUNDS} WHERE pos < 3 UNION ALL SELECT 'state.hand', unnest([0, 1, 2, 3]), -1.0, 1.0")
def bound_constants(spark, sf_dir):
    """What binding fixes: a data column's quantiles, and the own bounds of a rotation that changes its representation."""
    bound = _transform(spark, sf_dir)
    rows = [(k, i, float(a), float(b)) for k, n in bound.normalizers.items() if n.low is not None for i, (a, b) in enumerate(zip(n.low, n.high))]
    return spark.createDataFrame(rows, "key string, pos long, low double, high double").select("key", "pos", F.round("low", 5).alias("low"), F.round("high", 5).alias("high"))


_Q99 = "greatest(-2.2, least(2.2, CASE WHEN q01 = q99 THEN value ELSE 2 * (value - q01) / (q99 - q01) - 1 END))"
_TURN = "(SELECT vec_id, cos(a / 2) AS r, x * sin(a / 2) / a AS i, y * sin(a / 2) / a AS j, z * sin(a / 2) / a AS k FROM (SELECT *, sqrt(x * x + y * y + z * z) AS a FROM (SELECT vec_id, embedding[4]::DOUBLE AS x, embedding[5]::DOUBLE AS y, embedding[6]::DOUBLE AS z FROM embeddings)))"
_CELLS = "(SELECT vec_id, unnest(embedding[1:7])::DOUBLE AS value, generate_subscripts(embedding[1:7], 1) - 1 AS pos FROM embeddings)"


@query(
    "T09_rotate_normalize",
    f"""SELECT vec_id, 'state.arm' AS key, pos::BIGINT AS pos, round({_Q99}, 5) + 0.0 AS value FROM {_CELLS} JOIN {_BOUNDS} USING (pos) WHERE pos < 3
UNION ALL SELECT vec_id, 'state.hand', generate_subscripts([r, i, j, k], 1) - 1, round(unnest([r, i, j, k]), 5) + 0.0 FROM {_TURN}
UNION ALL SELECT vec_id, 'state.gripper', 0, (value > 0.05)::INT::DOUBLE FROM {_CELLS} WHERE pos = 6""",
)
def rotate_normalize(spark, sf_dir):
    """Rotation first, then each key's normalisation; quaternions lie within their own bounds and stay as they are."""
    return _flat(_transform(spark, sf_dir).apply(_states(spark, sf_dir)), *KEYS)


@query(
    "T10_back_again",
    f"""SELECT vec_id, CASE WHEN pos < 3 THEN 'state.arm' ELSE 'state.hand' END AS key, (pos % 3)::BIGINT AS pos, round(CASE WHEN pos < 3 THEN ({_Q99} + 1) / 2 * (q99 - q01) + q01 ELSE value END, 5) + 0.0 AS value
FROM {_CELLS} JOIN {_BOUNDS} USING (pos) WHERE pos < 6 UNION ALL SELECT vec_id, 'state.gripper', 0, (value > 0.05)::INT::DOUBLE FROM {_CELLS} WHERE pos = 6""",
)
def back_again(spark, sf_dir):
    """Normalisation taken back, then the rotation: what clamping and binarising took is gone, the rest is as it was."""
    t = _transform(spark, sf_dir)
    return _flat(t.unapply(t.apply(_states(spark, sf_dir))), *KEYS)


def _pipeline(spark, sf_dir):
    noise = T.OnlyTraining(lambda df: df.withColumn("state.arm", F.transform(F.col("`state.arm`"), lambda x: x + 1.0)))
    plain = T.StateAction(["state.arm", "state.hand"], {"state.arm": "min_max", "state.hand": "mean_std"})
    return T.Compose([noise, plain, T.Concat("state", ["state.hand", "state.arm"])]).bind(_metadata(spark, sf_dir))


@query("T14_composed", f"SELECT vec_id, 'state' AS key, (pos + 3)::BIGINT AS pos, round(2 * (value + 1 - lo) / (hi - lo) - 1, 5) + 0.0 AS value FROM {_CELLS} JOIN {_BOUNDS} USING (pos) WHERE pos < 3")
def composed(spark, sf_dir):
    """In training order: a training-only step, normalisation, one vector; the arm's part of it."""
    out = _pipeline(spark, sf_dir).mode(training=True).apply(_states(spark, sf_dir))
    return _flat(out, "state").where("pos >= 3")


@query("T15_unapply_actions", f"SELECT vec_id, 'state' AS key, ((pos + 3) % 6)::BIGINT AS pos, round(value, 5) + 0.0 AS value FROM {_CELLS} WHERE pos < 6")
def unapply_actions(spark, sf_dir):
    """A policy's vector over all keys, back through the training pipeline, in evaluation mode; as it was before."""
    keys, p = [("state.hand", 3), ("state.arm", 3)], _pipeline(spark, sf_dir).mode(training=False)
    return _flat(T.unapply_actions(p.apply(_states(spark, sf_dir)), "state", keys, T.Compose(p.steps[:-1])), "state")


@query(
    "T25_sin_cos_state",
    "SELECT vec_id, 'state' AS key, generate_subscripts(v, 1) - 1 AS pos, round(unnest(v), 5) + 0.0 AS value FROM (SELECT vec_id, [sin(x::DOUBLE) for x in embedding[1:3]] || [cos(x::DOUBLE) for x in embedding[1:3]] || [sin(embedding[7]::DOUBLE), cos(embedding[7]::DOUBLE)] AS v FROM embeddings)",
)
def sin_cos_state(spark, sf_dir):
    """Sines and cosines of each key, then all keys in order."""
    return _flat(T.sin_cos_by_key(_states(spark, sf_dir), ["state.arm", "state.gripper"]), "state")


# A turn as a sequence: one image or video (by conversation) whose merged grid depends on the turn, then the text's characters.
_SIZES = "(SELECT conv_id, turn, conv_id % 2 = 1 AS video, 1 + (conv_id % 2) * (1 + turn % 3) AS t, 1 + conv_id % 3 AS h, 1 + turn % 4 AS w, length(text) AS n, 0.5 * (1 + conv_id % 5) AS sec FROM conversations)"


def _sequences(spark, sf_dir, split):
    c = table(spark, sf_dir, "conversations")
    t = (1 + F.col("conv_id") % 2 * (1 + F.col("turn") % 3)).cast("int")
    h, w = (1 + F.col("conv_id") % 3).cast("int"), (1 + F.col("turn") % 4).cast("int")
    c = c.select("conv_id", "turn", (F.col("conv_id") % 2 == 1).alias("video"), t.alias("t"), h.alias("h"), w.alias("w"), F.char_length("text").alias("n"), (0.5 * (1 + F.col("conv_id") % 5)).alias("sec"))
    token = F.when(F.col("video"), P.VIDEO).otherwise(P.IMAGE)
    grid = lambda n: F.concat(F.array(F.lit(P.VISION_START)), F.array_repeat(token, n), F.array(F.lit(P.VISION_START + 1)))
    media = F.flatten(F.array_repeat(grid(F.col("h") * F.col("w")), F.col("t"))) if split else grid(F.col("t") * F.col("h") * F.col("w"))
    size = F.array(F.array(F.col("t"), F.col("h") * 2, F.col("w") * 2))
    none = F.array().cast("array<array<int>>")
    return c.select("*", F.concat(media, F.array_repeat(F.lit(7), F.col("n"))).alias("ids"), F.when(F.col("video"), none).otherwise(size).alias("images"), F.when(F.col("video"), size).otherwise(none).alias("videos"), F.when(F.col("video"), F.array("sec")).otherwise(F.array().cast("array<double>")).alias("seconds"))


def _sums(df, version, seconds=None):
    total = lambda c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda a, x: a + x)
    out = df.withColumn("p", P.position_ids(F.col("ids"), F.col("images"), F.col("videos"), version, 2, seconds))
    return out.select("conv_id", "turn", total("p.t").alias("t"), total("p.h").alias("h"), total("p.w").alias("w"), F.element_at("p.t", -1).cast("long").alias("last"))


def _one_grid(rate):
    """Sums over a start token, one grid from place 1, and a run of text after it."""
    return f"""WITH s AS {_SIZES}, g AS (SELECT *, {rate} AS rate FROM s), b AS (SELECT *, greatest(floor((t - 1) * rate)::BIGINT, h - 1, w - 1) + 2 AS rest FROM g)
SELECT conv_id, turn, (h * w * list_sum([1 + floor(f * rate)::BIGINT for f in range(t)]) + list_sum([rest + i for i in range(n + 1)]))::BIGINT AS t,
 (t * w * list_sum([1 + f for f in range(h)]) + list_sum([rest + i for i in range(n + 1)]))::BIGINT AS h, (t * h * list_sum([1 + f for f in range(w)]) + list_sum([rest + i for i in range(n + 1)]))::BIGINT AS w, (rest + n)::BIGINT AS last FROM b"""


@query(
    "N12_positions_by_frame",
    f"""WITH s AS {_SIZES}, b AS (SELECT *, greatest(h, w) AS far FROM s), c AS (SELECT *, 1 + (t - 1) * (far + 2) + far AS rest FROM b),
x AS (SELECT *, list_sum([CASE WHEN f = 0 THEN 0 ELSE 2 * (f * (far + 2)) - 1 END for f in range(t)]) + list_sum([rest + i for i in range(n + 1)]) AS words FROM c)
SELECT conv_id, turn, (words + h * w * list_sum([1 + f * (far + 2) for f in range(t)]))::BIGINT AS t, (words + w * list_sum([h * (1 + f * (far + 2)) + h * (h - 1) // 2 for f in range(t)]))::BIGINT AS h,
 (words + h * list_sum([w * (1 + f * (far + 2)) + w * (w - 1) // 2 for f in range(t)]))::BIGINT AS w, (rest + n)::BIGINT AS last FROM x""",
)
def positions_by_frame(spark, sf_dir):
    """Every frame of a video stands between tokens of its own and has no time inside."""
    return _sums(_sequences(spark, sf_dir, True), "frames")


@query("N13_positions_by_second", _one_grid("CASE WHEN video THEN sec * 2 ELSE 0 END"))
def positions_by_second(spark, sf_dir):
    return _sums(_sequences(spark, sf_dir, False), "seconds", F.col("seconds"))


@query("N14_positions_by_index", _one_grid("1.0"))
def positions_by_index(spark, sf_dir):
    return _sums(_sequences(spark, sf_dir, False), "index")
