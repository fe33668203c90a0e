"""Image steps on small arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstep.functions import images as I
from loomstep.operators import images as M

RNG = np.random.default_rng(1)
STACK = RNG.integers(0, 256, (2, 6, 9, 3), dtype=np.uint8)


@pytest.mark.parametrize("method", [*I.KERNELS, *I.NEAREST])
def test_resizing(method):
    flat = np.full((1, 7, 5, 3), 90, np.uint8)
    for h, w in ((3, 2), (14, 11), (7, 5)):
        assert (I.resized(flat, h, w, method) == 90).all()
    assert I.weights(9, 4, method).sum(axis=1) == pytest.approx(np.ones(4))
    ramp = np.tile(np.arange(0, 160, 10, dtype=np.uint8), (1, 4, 1))[..., None]
    small = I.resized(ramp, 4, 8, method)[0, 0, :, 0].astype(int)
    assert (np.diff(small) >= 0).all() and (np.abs(np.diff(small)[1:-1] - 20) <= 1).all()
    if method in ("bilinear", "box"):  # two by two
        assert I.resized(np.array([[0, 100], [200, 100]], np.uint8)[None, ..., None], 1, 1, method)[0, 0, 0, 0] == 100


def test_crops_and_flips():
    assert (I.crop(0.5, False)(STACK, 0.9) == STACK[:, 2:5, 2:6]).all()
    seen = {(int(np.argwhere((STACK == I.crop(0.5, True)(STACK, u)[0, 0, 0]).all(axis=3))[0][1])) for u in np.linspace(0, 0.999, 40)}
    assert seen <= set(range(4)) and len(seen) > 2
    assert (I.flip(STACK, 0) == STACK[:, :, ::-1]).all()
    maybe = I.sometimes(I.flip, 0.3)
    assert (maybe(STACK, 0.2) == STACK[:, :, ::-1]).all() and maybe(STACK, 0.3) is STACK


def test_colours_and_bytes():
    gray = I.gray(STACK, 0)
    assert (gray[..., 0] == gray[..., 2]).all() and abs(int(gray[0, 0, 0, 0]) - float(STACK[0, 0, 0] @ np.array(I.LUMA))) < 1
    assert set((I.posterize(2)(STACK, 0) % 64).ravel()) == {0}
    unit = I.to_unit(STACK, 6, 9)
    assert unit.shape == (2, 3, 6, 9) and unit.max() <= 1 and (np.abs(I.to_bytes(unit).astype(int) - STACK) <= 1).all()
    with pytest.raises(ValueError):
        I.to_unit(STACK, 9, 6)
    assert I.as_bytes(np.array([0.5, 1.0, 0.999])).tolist() == [127, 255, 254] and I.as_bytes(np.array([0.5]), True).tolist() == [128]
    assert I.as_bytes(STACK) is STACK


def test_letterbox():
    out = I.letterbox(8, 8)(np.full((1, 4, 8, 1), 7, np.uint8), 0)
    assert (out[0, 2:6] == 7).all() and not out[0, :2].any() and not out[0, 6:].any()
    assert I.letterbox(6, 9)(STACK, 0) is STACK


def test_patches():
    """Two views of 640 x 480 and 640 x 320 for a target of 224."""
    views = [np.zeros((480, 640, 3), np.uint8), np.zeros((320, 640, 3), np.uint8)]
    out = I.patched(views, 224, False)
    assert out.shape == (2, 3, 168, 224) and (out[1, :, :28] == 1).all() and (out[1, :, -28:] == 1).all() and not out[1, :, 28:-28].any()
    square = I.patched([np.zeros((100, 50, 3), np.uint8)], 56, True)
    assert square.shape == (1, 3, 56, 56) and (square[0, :, :, :14] == 1).all() and not square[0, :, :, 14:42].any()
    assert I.patched([np.zeros((900, 60, 3), np.uint8)], 56, False).shape == (1, 3, 56, 56)


def test_views_of_rows(spark):
    rows = spark.createDataFrame([(1, [0, 10, 20, 30]), (2, None)], "k int, p array<int>")
    one = F.when(F.col("p").isNotNull(), F.array(M.image(F.lit(2), F.lit(2), F.lit(1), F.col("p")), M.image(F.lit(1), F.lit(4), F.lit(1), F.col("p"))))
    out = M.map_views(rows.select("k", one.alias("v")), ["k"], "v", [I.flip])
    got = {r["k"]: [(v["height"], v["width"], list(v["data"])) for v in r["views"]] for r in out.collect()}
    assert got == {1: [(2, 2, [10, 0, 30, 20]), (1, 4, [30, 20, 10, 0])], 2: []}
    assert M.pixels(out, ["k"]).count() == 8


def test_patch_sizes_as_columns(spark):
    df = spark.createDataFrame([(int(h), int(w)) for h, w in RNG.integers(20, 900, (60, 2))], "h int, w int")
    for pad in (False, True):
        a, b = M.patch_size_columns(F.col("h"), F.col("w"), 224, pad)
        for r in df.select("h", "w", a.alias("a"), b.alias("b")).collect():
            assert (r["a"], r["b"]) == I.patch_sizes(r["h"], r["w"], 224, pad)
