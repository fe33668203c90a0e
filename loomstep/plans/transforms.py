"""Normalisation and its inverse, vectors, rotations, bins and schedules."""

import math

from pyspark.sql import functions as F

from loomstep.functions import rotations as R
from loomstep.functions import vectors as V
from loomstep.operators import stats as S
from loomstep.plans.registry import query, table
from loomstep.sources.stand_ins import CELLS_SQL, cells

_BOUNDS = f"(SELECT tag, pos, min(value) AS lo, max(value) AS hi, avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99 FROM {CELLS_SQL} GROUP BY tag, pos)"


def _bounded(spark, sf_dir):
    c = cells(spark, sf_dir)
    return c.join(S.describe(c, ["tag", "pos"]), ["tag", "pos"])


def _summary(df, x):
    out = df.withColumn("x", x).groupBy("tag", F.col("pos").cast("long").alias("pos"))
    return out.agg(*[(F.round(f, 4) + 0.0).alias(n) for f, n in ((F.min("x"), "least"), (F.avg("x"), "middle"), (F.max("x"), "most"), (F.avg(F.col("x") * F.col("x")), "square"))])


def _summary_sql(x):
    return f"SELECT tag, pos::BIGINT AS pos, round(min(x), 4) + 0.0 AS least, round(avg(x), 4) + 0.0 AS middle, round(max(x), 4) + 0.0 AS most, round(avg(x * x), 4) + 0.0 AS square FROM (SELECT tag, pos, {x} AS x FROM {CELLS_SQL} JOIN {_BOUNDS} USING (tag, pos)) GROUP BY 1, 2"


Q99 = "greatest(-2.2, least(2.2, CASE WHEN q01 = q99 THEN value ELSE 2 * (value - q01) / (q99 - q01) - 1 END))::DOUBLE"


@query("T01_normalize_q99", _summary_sql(Q99))
def normalize_q99(spark, sf_dir):
    return _summary(_bounded(spark, sf_dir), V.normalize(F.col("value"), "q99", F.col("q01"), F.col("q99")))


@query("T02_normalize_mean_std", _summary_sql("CASE WHEN std = 0 THEN value ELSE (value - mean) / std END"))
def normalize_mean_std(spark, sf_dir):
    return _summary(_bounded(spark, sf_dir), V.normalize(F.col("value"), "mean_std", F.col("mean"), F.col("std")))


@query("T03_normalize_min_max", _summary_sql("CASE WHEN lo = hi THEN 0 ELSE 2 * (value - lo) / (hi - lo) - 1 END"))
def normalize_min_max(spark, sf_dir):
    return _summary(_bounded(spark, sf_dir), V.normalize(F.col("value"), "min_max", F.col("min"), F.col("max")))


@query("T04_normalize_scale", _summary_sql("coalesce(value / nullif(greatest(abs(lo), abs(hi)), 0), 0)"))
def normalize_scale(spark, sf_dir):
    return _summary(_bounded(spark, sf_dir), V.normalize(F.col("value"), "scale", F.col("min"), F.col("max")))


@query("T05_binarize", _summary_sql("(value > 0.05)::INT::DOUBLE"))
def binarize(spark, sf_dir):
    return _summary(_bounded(spark, sf_dir), V.normalize(F.col("value"), "binary", threshold=0.05))


@query("T06_inverse_min_max", _summary_sql("value"))
def inverse_min_max(spark, sf_dir):
    """There and back again."""
    low, high = F.col("min"), F.col("max")
    return _summary(_bounded(spark, sf_dir), V.denormalize(V.normalize(F.col("value"), "min_max", low, high), "min_max", low, high))


@query("T06_inverse_mean_std", _summary_sql("value"))
def inverse_mean_std(spark, sf_dir):
    low, high = F.col("mean"), F.col("std")
    return _summary(_bounded(spark, sf_dir), V.denormalize(V.normalize(F.col("value"), "mean_std", low, high), "mean_std", low, high))


@query("T06_inverse_q99", _summary_sql(f"({Q99} + 1) / 2 * (q99 - q01) + q01"))
def inverse_q99(spark, sf_dir):
    low, high = F.col("q01"), F.col("q99")
    return _summary(_bounded(spark, sf_dir), V.denormalize(V.normalize(F.col("value"), "q99", low, high), "q99", low, high))


@query("T07_cast_float", "SELECT vec_id, round(list_sum([x::DOUBLE for x in embedding]), 3) + 0.0 AS total, len(embedding) AS dims FROM embeddings")
def cast_float(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>").cast("array<float>"))
    return e.select("vec_id", (F.round(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x), 3) + 0.0).alias("total"), F.size("v").cast("long").alias("dims"))


@query("T12_sin_cos", "SELECT vec_id, round(sin(embedding[1]::DOUBLE), 6) AS first, round(cos(embedding[64]::DOUBLE), 6) AS last, 2 * len(embedding) AS dims FROM embeddings")
def sin_cos(spark, sf_dir):
    v = V.sin_cos(F.col("embedding").cast("array<double>"))
    return table(spark, sf_dir, "embeddings").withColumn("v", v).select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.element_at("v", -1), 6).alias("last"), F.size("v").cast("long").alias("dims"))


@query("T13_concat_split", "SELECT vec_id, round(embedding[25]::DOUBLE, 6) AS hand_first, round(embedding[1]::DOUBLE, 6) AS arm_first, 64::BIGINT AS dims FROM embeddings")
def concat_split(spark, sf_dir):
    """Split by key, put together in another order, and split again."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", *V.split_parts(F.col("embedding").cast("array<double>"), [("arm", 24), ("hand", 24), ("gripper", 16)]))
    e = e.select("vec_id", F.concat("hand", "gripper", "arm").alias("v"))
    e = e.select("vec_id", F.size("v").cast("long").alias("dims"), *V.split_parts(F.col("v"), [("hand", 24), ("gripper", 16), ("arm", 24)]))
    return e.select("vec_id", F.round(F.get("hand", F.lit(0)), 6).alias("hand_first"), F.round(F.get("arm", F.lit(0)), 6).alias("arm_first"), "dims")


@query("T16_legacy_denormalize", _summary_sql("CASE WHEN pos <> 3 THEN 0.5 * ((CASE WHEN pos = 2 THEN (CASE WHEN y < 0.5 THEN 0.0 ELSE 1.0 END) ELSE y END) + 1) * (q99 - q01) + q01 ELSE y END").replace(f"FROM {CELLS_SQL} JOIN", f"FROM (SELECT tag, pos, greatest(-1.0, least(1.0, value / 20 - 1))::DOUBLE AS y, value FROM {CELLS_SQL}) JOIN"))
def legacy_denormalize(spark, sf_dir):
    y = V.legacy_denormalize(F.col("value") / 20 - 1, F.col("q01"), F.col("q99"), F.col("pos") != 3, F.col("pos") == 2)
    return _summary(_bounded(spark, sf_dir), y)


@query(
    "T17_linear_fit",
    f"WITH m AS (SELECT tag, pos, min(value) AS lo, max(value) AS hi, avg(value) AS mean, stddev_samp(value) AS std FROM {CELLS_SQL} GROUP BY 1, 2) SELECT tag, pos::BIGINT AS pos, round(2 / (hi - lo), 8) AS scale, round(-1 - 2 / (hi - lo) * lo, 6) AS offset_value, round(1 / std, 8) AS gaussian_scale, round(-mean / std, 6) AS gaussian_offset FROM m",
)
def linear_fit(spark, sf_dir):
    m = cells(spark, sf_dir).groupBy("tag", "pos").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    args = [F.col(c) for c in ("lo", "hi", "mean", "std")]
    (a, b), (c, d) = V.linear_fit("limits", *args), V.linear_fit("gaussian", *args)
    return m.select("tag", F.col("pos").cast("long").alias("pos"), F.round(a, 8).alias("scale"), F.round(b, 6).alias("offset_value"), F.round(c, 8).alias("gaussian_scale"), F.round(d, 6).alias("gaussian_offset"))


@query("T18_linear_normalize", _summary_sql("value * (2 / (hi - lo)) + (-1 - 2 / (hi - lo) * lo)"))
def linear_normalize(spark, sf_dir):
    a, b = V.linear_fit("limits", F.col("min"), F.col("max"), F.col("mean"), F.col("std"))
    return _summary(_bounded(spark, sf_dir), F.col("value") * a + b)


@query("T19_latest_from_history", "SELECT user_id AS episode, max(event_id) FILTER (WHERE (ts, event_id) = (SELECT (max(ts), max(event_id)) FROM events e WHERE e.user_id = events.user_id AND e.ts = (SELECT max(ts) FROM events f WHERE f.user_id = events.user_id))) AS latest FROM events GROUP BY 1")
def latest_from_history(spark, sf_dir):
    """One aggregate that keeps the newest row of each episode."""
    return V.latest(table(spark, sf_dir, "events"), [F.col("user_id").alias("episode")], ["ts", "event_id"], "event_id", "latest")


@query("T20_action_groups", "SELECT vec_id, round(list_sum([x::DOUBLE for x in embedding[1:7]]), 4) + 0.0 AS arm, round(list_sum([x::DOUBLE for x in embedding[8:13]]), 4) + 0.0 AS hand, round(embedding[14]::DOUBLE, 4) + 0.0 AS gripper FROM embeddings")
def action_groups(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", *V.split_parts(F.col("embedding").cast("array<double>"), [("arm", 7), ("hand", 6), ("gripper", 1)]))
    total = lambda c: (F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 4) + 0.0).alias(c)
    return e.select("vec_id", total("arm"), total("hand"), total("gripper"))


@query("T23_affine_dof", "SELECT vec_id, round(embedding[1]::DOUBLE * 1.5 - 0.25, 6) AS first, round(embedding[2]::DOUBLE * 0.5 + 1, 6) AS second FROM embeddings")
def affine_dof(spark, sf_dir):
    span, low = F.array(F.lit(1.5), F.lit(0.5)), F.array(F.lit(-0.25), F.lit(1.0))
    v = F.zip_with(F.zip_with(F.slice("embedding", 1, 2), span, lambda x, s: x.cast("double") * s), low, lambda x, b: x + b)
    return table(spark, sf_dir, "embeddings").withColumn("v", v).select("vec_id", F.round(F.get("v", F.lit(0)), 6).alias("first"), F.round(F.get("v", F.lit(1)), 6).alias("second"))


@query("T24_scatter_slot", "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS at_7, round(embedding[10]::DOUBLE, 6) AS at_16, 0.0::DOUBLE AS at_17, 80::BIGINT AS width FROM embeddings")
def scatter_slot(spark, sf_dir):
    v = V.scatter(V.part(F.col("embedding").cast("array<double>"), 0, 10), 7, 80, 10)
    at = lambda k: F.round(F.get("v", F.lit(k)), 6).alias(f"at_{k}")
    return table(spark, sf_dir, "embeddings").withColumn("v", v).select("vec_id", at(7), at(16), at(17), F.size("v").cast("long").alias("width"))


# A rotation of each vector: its first three elements as an axis-angle.
_AA = "SELECT vec_id, 4 * embedding[1]::DOUBLE AS x, 4 * embedding[2]::DOUBLE AS y, 4 * embedding[3]::DOUBLE AS z FROM embeddings"
_QUAT = f"SELECT vec_id, cos(a / 2) AS r, x * sin(a / 2) / a AS i, y * sin(a / 2) / a AS j, z * sin(a / 2) / a AS k FROM (SELECT *, sqrt(x * x + y * y + z * z) AS a FROM ({_AA}))"


def _axis_angle(spark, sf_dir):
    v = F.transform(F.slice("embedding", 1, 3), lambda x: 4 * x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", v.alias("v"))


def _named(df, vector, names, digits=5):
    return df.select("vec_id", *[(F.round(F.get(vector, F.lit(i)), digits) + 0.0).alias(n) for i, n in enumerate(names)])


@query("T11_axis_angle_to_quaternion", f"SELECT vec_id, round(r * sign(r), 5) + 0.0 AS r, round(i * sign(r), 5) + 0.0 AS i, round(j * sign(r), 5) + 0.0 AS j, round(k * sign(r), 5) + 0.0 AS k FROM ({_QUAT})")
def axis_angle_to_quaternion(spark, sf_dir):
    """Through the matrix, which forgets the sign: the real part comes out positive. One choice of square may leave a
    negative one, so it is made positive here."""
    q = _axis_angle(spark, sf_dir).withColumn("q", R.convert(F.col("v"), "axis_angle", "quaternion"))
    flip = F.when(F.get("q", F.lit(0)) < 0, -1.0).otherwise(1.0)
    return _named(q.withColumn("q", F.transform("q", lambda x: x * flip)), "q", "rijk")


@query(
    "T11_axis_angle_to_6d",
    f"SELECT vec_id, round(1 - 2 * (j * j + k * k), 5) + 0.0 AS a0, round(2 * (i * j - k * r), 5) + 0.0 AS a1, round(2 * (i * k + j * r), 5) + 0.0 AS a2, round(2 * (i * j + k * r), 5) + 0.0 AS a3, round(1 - 2 * (i * i + k * k), 5) + 0.0 AS a4, round(2 * (j * k - i * r), 5) + 0.0 AS a5 FROM ({_QUAT})",
)
def axis_angle_to_6d(spark, sf_dir):
    return _named(_axis_angle(spark, sf_dir).withColumn("d", R.convert(F.col("v"), "axis_angle", "rotation_6d")), "d", [f"a{i}" for i in range(6)])


@query("T11_rotation_round_trip", f"SELECT vec_id, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y, round(z, 5) + 0.0 AS z FROM ({_AA}) WHERE sqrt(x * x + y * y + z * z) < 3.1")
def rotation_round_trip(spark, sf_dir):
    """Axis-angle, 6D, Euler angles, quaternion and back."""
    df = _axis_angle(spark, sf_dir).where(V.norm(F.col("v")) < 3.1)
    path = ["axis_angle", "rotation_6d", "euler_angles_zyx", "quaternion", "axis_angle"]
    for a, b in zip(path, path[1:]):
        df = df.select("vec_id", R.convert(F.col("v"), a, b).alias("v"))
    return _named(df, "v", "xyz")


@query("T21_quaternion_to_axis_angle", f"SELECT vec_id, round(i * 2 * acos(r) / sqrt(1 - r * r), 5) + 0.0 AS x, round(j * 2 * acos(r) / sqrt(1 - r * r), 5) + 0.0 AS y, round(k * 2 * acos(r) / sqrt(1 - r * r), 5) + 0.0 AS z FROM ({_QUAT})")
def quaternion_to_axis_angle(spark, sf_dir):
    q = R.quaternion_from_axis_angle(F.col("v"))
    df = _axis_angle(spark, sf_dir).withColumn("q", q).withColumn("q", F.concat(F.slice("q", 2, 3), F.slice("q", 1, 1)))
    return _named(df.withColumn("a", R.axis_angle_from_quaternion_xyzw(F.col("q"))), "a", "xyz")


_B1 = "SELECT vec_id, e, x / n AS x, y / n AS y, z / n AS z FROM (SELECT vec_id, embedding AS e, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, sqrt(embedding[1]::DOUBLE ** 2 + embedding[2]::DOUBLE ** 2 + embedding[3]::DOUBLE ** 2) AS n FROM embeddings)"


@query("T22_6d_to_matrix", f"SELECT vec_id, round(x, 5) + 0.0 AS m0, round(y, 5) + 0.0 AS m3, round(z, 5) + 0.0 AS m6, 1.0::DOUBLE AS det FROM ({_B1})")
def six_to_matrix(spark, sf_dir):
    m = table(spark, sf_dir, "embeddings").select("vec_id", R.from_6d(F.slice(F.col("embedding").cast("array<double>"), 1, 6), as_columns=True).alias("m"))
    g = lambda k: F.get("m", F.lit(k))
    det = g(0) * (g(4) * g(8) - g(5) * g(7)) - g(1) * (g(3) * g(8) - g(5) * g(6)) + g(2) * (g(3) * g(7) - g(4) * g(6))
    return m.select("vec_id", *[(F.round(g(k), 5) + 0.0).alias(f"m{k}") for k in (0, 3, 6)], F.round(det, 5).alias("det"))


@query("N01_bins", "SELECT floor(least(greatest((value / 250 - 1 + 1) / 2, 1e-6), 1 - 1e-6) * 256)::BIGINT AS bin, count(*) AS n FROM events GROUP BY 1")
def bins(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(V.to_bin(F.col("value") / 250 - 1, 256).alias("bin")).agg(F.count("*").alias("n"))


@query("N02_bin_centers", "SELECT event_id, round((floor(least(greatest(value / 250 / 2, 1e-6), 1 - 1e-6) * 256) + 0.5) * (2.0::DOUBLE / 256) - 1, 6) AS center FROM events")
def bin_centers(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(V.bin_center(V.to_bin(F.col("value") / 250 - 1, 256), 256), 6).alias("center"))


@query("N03_bits", "SELECT event_id, array_to_string([((event_id % 256) >> i) & 1 for i in range(8)], '') AS bits FROM events")
def index_bits(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(V.bits(F.col("event_id") % 256), lambda b: b.cast("string")), "").alias("bits"))


@query("N04_argmax", "SELECT vec_id, list_position(embedding, list_max(embedding))::BIGINT - 1 AS best, round(list_max(embedding)::DOUBLE, 6) AS logit FROM embeddings")
def best_index(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", V.argmax(F.col("embedding")).alias("best"), F.round(F.array_max("embedding").cast("double"), 6).alias("logit"))


@query("N05_train_mask", "SELECT event_id, round(least(greatest(1 - cos(pi() * 0.5 * (event_id % 100) / 100.0), 1e-6), 1), 7) AS cosine, round(least(greatest((event_id % 100) / 100.0::DOUBLE, 1e-6), 1), 7) AS linear FROM events")
def train_mask(spark, sf_dir):
    t = (F.col("event_id") % 100) / 100.0
    return table(spark, sf_dir, "events").select("event_id", F.round(V.train_mask_ratio(t), 7).alias("cosine"), F.round(V.train_mask_ratio(t, "linear"), 7).alias("linear"))


@query("N06_decode_mask", "SELECT event_id, round(0.5 * (1 + cos(pi() * (event_id % 101) / 100.0)), 7) + 0.0 AS cosine, round(1 - (event_id % 101) / 100.0::DOUBLE, 7) AS linear FROM events")
def decode_mask(spark, sf_dir):
    r = (F.col("event_id") % 101) / 100.0
    return table(spark, sf_dir, "events").select("event_id", (F.round(V.decode_mask_ratio(r), 7) + 0.0).alias("cosine"), F.round(V.decode_mask_ratio(r, "linear"), 7).alias("linear"))


KINDS = ("linear", "quad", "warmup10", "warmup50", "const", "jsd")


@query(
    "N07_beta_schedules",
    """SELECT t, round(0.0001 + 0.0199 * t / 99.0::DOUBLE, 9) AS linear, round((0.01 + (sqrt(0.02) - 0.01) * t / 99.0::DOUBLE) ** 2, 9) AS quad,
 round(CASE WHEN t < 10 THEN 0.0001 + 0.0199 * t / 9.0::DOUBLE ELSE 0.02 END, 9) AS warmup10, round(CASE WHEN t < 50 THEN 0.0001 + 0.0199 * t / 49.0::DOUBLE ELSE 0.02 END, 9) AS warmup50,
 0.02::DOUBLE AS const, round(1 / (100.0::DOUBLE - t), 9) AS jsd FROM range(100) AS r(t)""",
)
def beta_schedules(spark, sf_dir):
    t = F.col("id").cast("double")
    return spark.range(100).select(F.col("id").alias("t"), *[F.round(V.beta_schedule(t, k, 100), 9).alias(k) for k in KINDS])


@query("N08_cosine_betas", f"SELECT t, round(least(1 - cos(((t + 1) / 100.0::DOUBLE + 0.008) / 1.008 * {math.pi} / 2) ** 2 / cos((t / 100.0::DOUBLE + 0.008) / 1.008 * {math.pi} / 2) ** 2, 0.999), 8) AS beta FROM range(100) AS r(t)")
def cosine_betas(spark, sf_dir):
    return spark.range(100).select(F.col("id").alias("t"), F.round(V.beta_schedule(F.col("id").cast("double"), "cosine", 100), 8).alias("beta"))


@query(
    "N09_forward_diffusion",
    "WITH b AS (SELECT t, exp(sum(ln(1 - (0.0001 + 0.0199 * t / 99.0::DOUBLE))) OVER (ORDER BY t)) AS bar FROM range(100) AS r(t)) SELECT event_id, round(sqrt(bar) * value + sqrt(1 - bar) * 0.5, 5) AS noisy FROM events JOIN b ON t = event_id % 100",
)
def forward_diffusion(spark, sf_dir):
    from pyspark.sql import Window

    beta = V.beta_schedule(F.col("id").cast("double"), "linear", 100)
    bar = spark.range(100).select(F.col("id").alias("t"), F.exp(F.sum(F.log(1 - beta)).over(Window.orderBy("id"))).alias("bar"))
    e = table(spark, sf_dir, "events").withColumn("t", F.col("event_id") % 100)
    return e.join(F.broadcast(bar), "t").select("event_id", F.round(F.sqrt("bar") * F.col("value") + F.sqrt(1 - F.col("bar")) * 0.5, 5).alias("noisy"))


_PULL = "list_sum([a[i] * v[i] for i in range(1, 33)])"


@query("N16_projection", f"SELECT vec_id, (i - 1)::BIGINT AS pos, round(v[i] - least({_PULL} / (list_sum([x * x for x in a]) + 1e-6), 0) * a[i], 5) + 0.0 AS value FROM (SELECT vec_id, a, v, unnest(range(1, 33)) AS i FROM (SELECT vec_id, [x::DOUBLE for x in embedding[1:32]] AS a, [x::DOUBLE for x in embedding[33:64]] AS v FROM embeddings))")
def projection(spark, sf_dir):
    """The second half of each vector without what works against the first."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 32).cast("array<double>").alias("a"), F.slice("embedding", 33, 32).cast("array<double>").alias("v"))
    out = e.select("vec_id", F.posexplode(V.project(F.col("a"), F.col("v"))).alias("pos", "value"))
    return out.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.round("value", 5) + 0.0).alias("value"))
