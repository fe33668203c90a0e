"""Image steps on vectors seen as pictures: eight by eight places, one or three channels, one or two views."""

from pyspark.sql import functions as F

from loomstep.functions import images as I
from loomstep.operators import images as M
from loomstep.plans.registry import query, table

_PIXEL = "greatest(0, least(255, floor((x::DOUBLE * 4 + 0.5) * 256)))::BIGINT"
_FLAT = f"(SELECT vec_id, i // 8 AS y, i % 8 AS x, {_PIXEL} AS value FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings))"
# Three channels of each place: the pixel, its opposite, and half of it.
_COLOUR = f"(SELECT vec_id, y, x, value AS r, 255 - value AS g, value // 2 AS b FROM {_FLAT})"


def _unit(level):
    return f"('0x' || md5('0:' || vec_id || ':{level}')[1:13])::BIGINT::DOUBLE / 4503599627370496.0"


def _pictures(spark, sf_dir, colour=False, views=1):
    e = table(spark, sf_dir, "embeddings")
    value = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") * 4 + 0.5) * 256))).cast("int"))
    e = e.select("vec_id", value.alias("p"))
    if colour:
        e = e.withColumn("p", F.flatten(F.transform("p", lambda v: F.array(v, 255 - v, F.floor(v / 2).cast("int")))))
    one = M.image(F.lit(8), F.lit(8), F.lit(3 if colour else 1), F.col("p"))
    two = M.image(F.lit(8), F.lit(8), F.lit(3 if colour else 1), F.reverse("p"))
    return e.select("vec_id", F.array(*[one, two][:views]).alias("views"))


def _run(spark, sf_dir, *steps, colour=False, views=1):
    out = M.pixels(M.map_views(_pictures(spark, sf_dir, colour, views), ["vec_id"], "views", steps), ["vec_id"])
    return out.select("vec_id", *(["view"] if views > 1 else []), "y", "x", *(["channel"] if colour else []), "value")


_PLACE = f"floor({_unit(0)} * 9)::BIGINT"


@query(
    "V01_views_together",
    f"SELECT vec_id, view, y - top AS y, x - lft AS x, value FROM (SELECT vec_id, 0::BIGINT AS view, y, x, value FROM {_FLAT} UNION ALL SELECT vec_id, 1::BIGINT, 7 - y, 7 - x, value FROM {_FLAT}) JOIN (SELECT vec_id, {_PLACE} // 3 AS top, {_PLACE} % 3 AS lft FROM embeddings) USING (vec_id) WHERE y BETWEEN top AND top + 5 AND x BETWEEN lft AND lft + 5",
)
def views_together(spark, sf_dir):
    """Both views of a row are cut at the same drawn place."""
    return _run(spark, sf_dir, I.crop(0.8, training=True), views=2)


@query("V02_center_crop", f"SELECT vec_id, y - 1 AS y, x - 1 AS x, value FROM {_FLAT} WHERE y BETWEEN 1 AND 6 AND x BETWEEN 1 AND 6")
def center_crop(spark, sf_dir):
    return _run(spark, sf_dir, I.crop(0.8, training=False))


# A half-sized picture by the triangle kernel: a new place takes of the four around it an eighth, three eighths, and so on.
_HALF = "(VALUES (0, 0, 3/7.0), (0, 1, 3/7.0), (0, 2, 1/7.0), (1, 1, 0.125), (1, 2, 0.375), (1, 3, 0.375), (1, 4, 0.125), (2, 3, 0.125), (2, 4, 0.375), (2, 5, 0.375), (2, 6, 0.125), (3, 5, 1/7.0), (3, 6, 3/7.0), (3, 7, 3/7.0)) AS k(o, i, k)"
_HALVED = f"(SELECT vec_id, o::BIGINT AS y, x::BIGINT AS x, floor(sum(k::DOUBLE * value) + 0.5)::BIGINT AS value FROM (SELECT vec_id, y, o AS x, floor(sum(k::DOUBLE * value) + 0.5) AS value FROM {_FLAT} JOIN {_HALF} ON i = x GROUP BY 1, 2, 3) JOIN {_HALF} ON i = y GROUP BY 1, 2, 3)"


@query("V03_resize_half", f"SELECT vec_id, y, x, value FROM {_HALVED}")
def resize_half(spark, sf_dir):
    return _run(spark, sf_dir, I.resize(4, 4, "bilinear"))


@query("V05_flip", f"SELECT vec_id, y, CASE WHEN {_unit(0)} < 0.5 THEN 7 - x ELSE x END AS x, value FROM {_FLAT}")
def flip(spark, sf_dir):
    return _run(spark, sf_dir, I.sometimes(I.flip, 0.5))


_GRAY = "floor(0.2989::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b + 1e-9)::BIGINT"


@query("V06_gray", f"SELECT vec_id, y, x, unnest([0, 1, 2])::BIGINT AS channel, {_GRAY} AS value FROM {_COLOUR}")
def gray(spark, sf_dir):
    return _run(spark, sf_dir, I.gray, colour=True)


@query("V08_random_gray", f"SELECT vec_id, y, x, unnest([0, 1, 2])::BIGINT AS channel, unnest(CASE WHEN {_unit(0)} < 0.25 THEN [{_GRAY}, {_GRAY}, {_GRAY}] ELSE [r, g, b] END) AS value FROM {_COLOUR}")
def random_gray(spark, sf_dir):
    return _run(spark, sf_dir, I.sometimes(I.gray, 0.25), colour=True)


@query("V09_posterize", f"SELECT vec_id, y, x, value // 32 * 32 AS value FROM {_FLAT}")
def posterize(spark, sf_dir):
    return _run(spark, sf_dir, I.posterize(3))


@query("V11_there_and_back", f"SELECT vec_id, y, x, floor((value::FLOAT / 255::FLOAT)::FLOAT * 255::FLOAT)::BIGINT AS value FROM {_FLAT}")
def there_and_back(spark, sf_dir):
    """Bytes to numbers with the channel first, and back with the rest cut off."""
    return _run(spark, sf_dir, lambda x, u: I.to_bytes(I.to_unit(x, 8, 8)))


@query("V13_letterbox", f"SELECT vec_id, y::BIGINT AS y, x::BIGINT AS x, coalesce(value, 0) AS value FROM (SELECT vec_id, y, unnest(range(8)) AS x FROM (SELECT vec_id, unnest(range(4)) AS y FROM embeddings)) LEFT JOIN (SELECT vec_id, y, x + 2 AS x, value FROM {_HALVED}) USING (vec_id, y, x)")
def letterbox(spark, sf_dir):
    return _run(spark, sf_dir, I.letterbox(4, 8))


@query("V14_rounded_bytes", f"SELECT vec_id, y, x, floor(value / 510.0 * 255 + 0.5)::BIGINT AS value FROM {_FLAT}")
def rounded_bytes(spark, sf_dir):
    """Numbers from 0 to 1 as bytes, rounded."""
    return _run(spark, sf_dir, lambda x, u: I.as_bytes(x / 510.0, rounded=True))


_SIDES = "(SELECT p_partkey, (40 + p_size * 13)::DOUBLE AS h, (60 + p_partkey % 500)::DOUBLE AS w FROM part)"


@query(
    "V15_patch_sizes",
    f"SELECT p_partkey, (round_even(h * (224.0::DOUBLE / w) / 14, 0) * 14)::BIGINT AS crop_height, CASE WHEN h > w THEN 224 ELSE (round_even(h * (224.0::DOUBLE / w) / 14, 0) * 14)::BIGINT END AS pad_height, CASE WHEN h > w THEN (round_even(w * (224.0::DOUBLE / h) / 14, 0) * 14)::BIGINT ELSE 224 END AS pad_width FROM {_SIDES}",
)
def patch_sizes(spark, sf_dir):
    h, w = (40 + F.col("p_size") * 13).cast("double"), (60 + F.col("p_partkey") % 500).cast("double")
    (tall, _), (a, b) = M.patch_size_columns(h, w, 224, False), M.patch_size_columns(h, w, 224, True)
    return table(spark, sf_dir, "part").select("p_partkey", tall.alias("crop_height"), a.alias("pad_height"), b.alias("pad_width"))


@query("V16_list_resize", f"SELECT vec_id, 0::BIGINT AS view, y, x, value FROM {_HALVED} UNION ALL SELECT vec_id, 1::BIGINT, 3 - y, 3 - x, value FROM {_HALVED}")
def list_resize(spark, sf_dir):
    return _run(spark, sf_dir, I.resize(4, 4), views=2)
