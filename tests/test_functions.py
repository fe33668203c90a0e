"""Closed-form cases of column functions and operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstep.functions import rotations as R
from loomstep.functions import text as X
from loomstep.functions import vectors as V
from loomstep.operators import conversations as C
from loomstep.operators import evaluation as E
from loomstep.operators import lookups as L
from loomstep.operators import mixture as M
from loomstep.operators import stats as S
from loomstep.operators import windows as W


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def doubles(*v):
    return F.array(*[F.lit(float(x)) for x in v])


def test_state_tokens_and_clean_instruction(spark):
    assert one(spark, V.state_tokens(doubles(-0.5, 0.1, 0.8))) == "64 140 230"
    assert one(spark, V.state_tokens(doubles(-1.5, 1.5))) == "-1 255"
    assert one(spark, X.clean_instruction(F.lit("  pick   object  "))) == "pick object"
    assert one(spark, X.clean_instruction(F.lit(" \n"))) == X.DEFAULT_INSTRUCTION
    assert one(spark, X.human_bytes(F.lit(1536.0))) == "1.50 KiB"
    assert one(spark, X.json_in_text(F.lit('so {"a":\n1} end'))) == '{"a":\n1}'
    assert one(spark, X.split_media(F.lit("<image>a<video><image>b"))) == ["<image>", "a", "<video>", "<image>", "b"]


def test_fit_and_mask(spark):
    rows = F.array(*[doubles(1, 1, 1, 1, 1)] * 3)
    fit, mask = np.array(one(spark, V.fit_rows(rows, 8, 7))), np.array(one(spark, V.fit_mask(rows, 8, 7)))
    assert fit.shape == mask.shape == (8, 7) and mask.sum() == 15 and (fit[:, :5] == 1).all() and (fit[:, 5:] == 0).all()
    assert not one(spark, V.all_finite(F.array(doubles(1, float("nan"))))) and one(spark, V.all_finite(F.array(doubles(1, 2))))


def test_scatter_and_groups(spark):
    got = one(spark, V.scatter(doubles(*range(1, 11)), 7, 80, 10))
    assert len(got) == 80 and got[7:17] == list(map(float, range(1, 11))) and sum(got) == 55
    assert len(one(spark, V.sin_cos(doubles(*range(29))))) == 58


def test_incomplete_chunks_are_left_out(spark):
    df = spark.range(35).selectExpr("id as t", "35 as length")
    assert [r["t"] for r in W.complete_bases(df, "t", "length", range(1, 31)).orderBy("t").collect()] == list(range(5))
    assert W.history_offsets(3, 2) == [-6, -4, -2]
    W.check_offsets([-4, -2, 0], 3)
    for bad in ([-3, -2, 0], [-1, 0, 1], [0, -1, -2]):
        with pytest.raises(ValueError):
            W.check_offsets(bad, 3)


def test_masked_l1(spark):
    df = spark.createDataFrame([(1.0, 0.0, True), (100.0, 0.0, False), (3.0, 0.0, True), (100.0, 0.0, False)], "p double, t double, m boolean")
    assert S.masked_l1(df, "p", "t", "m").first()[0] == 2.0
    assert S.masked_l1(df, "p", "t", None).first()[0] == 51.0
    with pytest.raises(Exception, match="a mask is empty"):
        S.require(S.masked_l1(df.withColumn("m", F.lit(False)), "p", "t", "m"), F.col("loss").isNotNull(), "a mask is empty").collect()


@pytest.mark.parametrize("mode", ["q99", "mean_std", "min_max"])
def test_inverse_of_normalize(spark, mode):
    for low, high in ((-1.0, 3.0), (2.0, 2.5)):
        bounds = F.lit(low), F.lit(high)
        assert one(spark, V.denormalize(V.normalize(F.lit(2.1), mode, *bounds), mode, *bounds)) == pytest.approx(2.1)


def test_constant_dimensions(spark):
    same = F.lit(2.0), F.lit(2.0)
    assert one(spark, V.normalize(F.lit(1.5), "q99", *same)) == 1.5
    assert one(spark, V.normalize(F.lit(9.5), "q99", *same)) == V.CLAMP
    assert one(spark, V.normalize(F.lit(9.5), "min_max", *same)) == 0.0
    assert one(spark, V.normalize(F.lit(9.5), "mean_std", F.lit(1.0), F.lit(0.0))) == 9.5
    assert one(spark, V.normalize(F.lit(9.5), "scale", F.lit(0.0), F.lit(0.0))) == 0.0


@pytest.mark.parametrize("kind", R.KINDS)
def test_rotations_round_trip(spark, kind):
    for v in ((0.3, -0.7, 1.1), (0.0, 0.0, 0.0), (3.0, 0.1, -0.2), (1e-9, 0.0, 0.0)):
        m = one(spark, R.to_matrix(doubles(*v), "axis_angle"))
        again = one(spark, R.to_matrix(R.from_matrix(doubles(*m), kind), kind))
        assert again == pytest.approx(m, abs=1e-6)
    assert np.linalg.det(np.array(m).reshape(3, 3)) == pytest.approx(1)


def test_euler_is_the_product_of_axes(spark):
    def axis(a, t):
        c, s = math.cos(t), math.sin(t)
        return {"x": [[1, 0, 0], [0, c, -s], [0, s, c]], "y": [[c, 0, s], [0, 1, 0], [-s, 0, c]], "z": [[c, -s, 0], [s, c, 0], [0, 0, 1]]}[a]

    want = np.array(axis("z", 0.2)) @ axis("x", -0.4) @ axis("y", 0.9)
    assert one(spark, R.to_matrix(doubles(0.2, -0.4, 0.9), "euler_angles_zxy")) == pytest.approx(want.ravel())


def test_label_mask(spark):
    def plain(ids):
        out, pos = [C.IGNORE] * len(ids), 0
        while pos < len(ids):
            if ids[pos] == C.START:
                stop = next((e for e in range(pos + 2, len(ids)) if ids[e] == C.STOP), None)
                if stop is not None:
                    out[pos + 2 : stop + 2] = ids[pos + 2 : stop + 2]
                    pos = stop
            pos += 1
        return out

    rng = np.random.default_rng(0)
    cases = [rng.choice([C.START, C.STOP, 1, 2, 3], rng.integers(1, 25), p=[0.2, 0.2, 0.2, 0.2, 0.2]).tolist() for _ in range(60)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, ids array<int>")
    for r in df.select("i", C.label_mask(F.col("ids")).alias("labels")).collect():
        assert r["labels"] == plain(cases[r["i"]])


def test_success_summary(spark):
    df = spark.createDataFrame([(True,), (False,), (True,)], "s boolean")
    assert df.agg(F.count("*"), F.sum(F.col("s").cast("int")), E.success_rate(F.col("s"))).first() == (3, 2, 2 / 3)
    assert df.where("false").agg(E.success_rate(F.col("s"))).first()[0] == 0.0


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    left = [(int(k), i, float(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 3, 60), rng.integers(0, 30, 60)))]
    right = [(int(k), 100 + i, float(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 2, 25), rng.choice(60, 25, replace=False) / 2))]
    got = L.nearest(spark.createDataFrame(left, "k int, i int, t double"), spark.createDataFrame(right, "k int, r int, rt double"), ["k"], "t", "rt", "r")
    for row in got.collect():
        able = [(abs(t - row["t"]), t, r) for k, r, t in right if k == row["k"]]
        assert row["nearest"] == (min(able)[2] if able else None)


def test_chunks_by_position_are_chunks(spark):
    df = spark.range(40).selectExpr("id % 3 as e", "id as t", "cast(id * id as double) as v")
    for offsets in (range(5), [-4, -2, 0, 3]):
        a = W.chunk(df, ["e"], ["t"], "v", offsets).orderBy("t").collect()
        assert a == W.chunk_by_position(df, ["e"], ["t"], "v", offsets).orderBy("t").collect()


def test_sticky_gripper_holds():
    state = E.GripperState()
    assert [state.step(x, 3, 0.5) for x in (1.0, 0.9, 0.0, 0.2, 1.0, 1.0, 0.0)] == pytest.approx([0, 0.1, 1.0, 1.0, 1.0, -1.0, -1.0])


def test_exact_draw_is_numpys(spark):
    import hashlib

    rows = M.exact_draw(spark.range(20).withColumnRenamed("id", "index"), {0: [1.0], 1: [0.25, 0.75]}, {0: [10], 1: [5, 7]}, [0.3, 0.7], seed=42).collect()
    for r in rows:
        rng = np.random.default_rng(int(hashlib.sha256(repr((0, r["index"], 42)).encode()).hexdigest()[-32:], 16))
        d = rng.choice(2, p=[0.3, 0.7])
        e = rng.choice(len([[10], [5, 7]][d]), p=[[1.0], [0.25, 0.75]][d])
        assert (r["dataset"], r["episode"], r["step"]) == (d, e, rng.choice([[10], [5, 7]][d][e]))


def test_exact_draw_of_many_episodes(spark):
    """As numpy's generators, one by one, and without adding up all shares for every draw: 20,000 draws among 200,000 episodes."""
    import hashlib
    import time

    rng = np.random.default_rng(1)
    share, steps = rng.random(200_000), rng.integers(1, 9, 200_000)
    steps[:1000] = 3_000_000_000  # numpy draws again for such a number three times in ten
    share[:1000] *= 100
    share /= share.sum()
    began = time.time()
    rows = M.exact_draw(spark.range(20_000).withColumnRenamed("id", "index"), {0: [1.0], 1: share.tolist()}, {0: [1], 1: steps.tolist()}, [0.1, 0.9], seed=7, epoch=3).collect()
    assert time.time() - began < 20
    weights, upto = np.cumsum([0.1, 0.9]), np.cumsum(share)
    weights, within = weights / weights[-1], [np.ones(1), upto / upto[-1]]
    for r in rows:
        rng = np.random.default_rng(int(hashlib.sha256(repr((3, r["index"], 7)).encode()).hexdigest()[-32:], 16))
        d = int(np.searchsorted(weights, rng.random(), "right"))
        e = int(np.searchsorted(within[d], rng.random(), "right"))
        assert (r["dataset"], r["episode"], r["step"]) == (d, e, rng.choice([1, steps[e]][d]))


def test_linear_fit_of_flat_dimension(spark):
    scale, offset = V.linear_fit("limits", F.lit(3.0), F.lit(3.0), F.lit(3.0), F.lit(0.0))
    assert one(spark, scale) == 1.0 and one(spark, offset) == -3.0


def test_dispatch_without_and_families(spark):
    df = spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), (None, None)], "k string, n string")
    assert [r["x"] for r in df.select(L.dispatch(F.col("k"), {"a": F.lit(1)}, F.lit(0)).alias("x")).collect()] == [1, 0, 0]
    with pytest.raises(Exception, match="unknown kind: b"):
        df.select(L.dispatch(F.col("k"), {"a": F.lit(1)})).collect()
    assert [r["k"] for r in L.without(df, "k", ["a"]).collect()] == ["b", None] and L.without(df, "k", []).count() == 3
    assert [r["k"] for r in L.select_families(df, "n", ["ALPHA", "second"], {"second": "beta"}).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="gamma"):
        L.select_families(df, "n", ["gamma"])
    row = df.select(L.pack_sample([F.array(F.lit(1.0)), F.array(F.lit(2.0))], [F.array(F.lit(3.0))], F.col("n"), "arm").alias("s")).first()["s"]
    assert (row["action"], row["state"], row["lang"], row["robot_tag"]) == ([1.0, 2.0], [3.0], "Alpha", "arm")


def test_cycling_zip_and_same_set(spark):
    a, b = spark.range(7).selectExpr("id * 3 as x"), spark.range(3).selectExpr("id * 100000 as y")
    assert [(r["step"], r["x"], r["y"]) for r in L.zip_cycling(a, b, "x", "y").orderBy("step").collect()] == [(i, 3 * i, i % 3 * 100000) for i in range(7)]
    assert L.zip_cycling(a, b.where("y < 0"), "x", "y").count() == 0
    assert L.same_set(a, a.unionByName(a), "x", "x").first()["equal"] and not L.same_set(a, b, "x", "y").first()["equal"]


def test_rank_violation_against_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(r), float(s)) for i, (r, s) in enumerate(zip(rng.integers(0, 6, 30), rng.integers(0, 6, 30)))]
    worst = [max([abs(r - q) for _, q, u in rows if (s < u) != (r < q)], default=0.0) for _, r, s in rows]
    got = E.mean_maximum_rank_violation(spark.createDataFrame(rows, "k int, re double, sim double"), "k", "re", "sim").first()["mmrv"]
    assert got == pytest.approx(np.mean(worst))


def test_exact_sample_takes_the_least_hashes(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = sorted(r["k"] for r in M.exact_sample(df, "k", 0.3, cells=16).collect())
    want = sorted(r["k"] for r in df.orderBy(M.hash_unit(F.lit(0), F.col("k")), "k").limit(150).collect())
    assert got == want and M.exact_sample(df, "k", 0.0).count() == 0 and M.exact_sample(df, "k", 1.0).count() == 500


def test_label_mask_is_linear(spark):
    """Twice the ids take about twice the time: far from four times."""
    import time

    def seconds(n):
        rows = spark.range(40).selectExpr(f"transform(sequence(1, {n}), i -> cast(CASE i % 11 WHEN 3 THEN {C.START} WHEN 8 THEN {C.STOP} ELSE i END as int)) as ids")
        out = rows.select(C.label_mask(F.col("ids")).alias("labels")).write.format("noop").mode("overwrite")
        out.save()
        began = time.perf_counter()
        out.save()
        return time.perf_counter() - began

    assert seconds(40_000) < 3 * max(seconds(20_000), 0.5)


def test_projection_and_wire(spark):
    assert one(spark, V.project(doubles(1, 0), doubles(-2, 3))) == pytest.approx([0, 3], abs=1e-5)
    assert one(spark, V.project(doubles(1, 0), doubles(2, 3))) == [2.0, 3.0]
    from loomstep.sources import wire

    for value in (np.arange(6, dtype=np.int16).reshape(2, 3), np.zeros((0, 2)), np.float32(0.5)):
        back = wire.unpacked(wire.packed(value))
        assert back.dtype == value.dtype and np.array_equal(back, value)
    assert wire.packed("x") == "x" and wire.unpacked({"a": 1}) == {"a": 1}
    with pytest.raises(ValueError):
        wire.packed(np.array([object()]))


def test_replay(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    rows = sorted((r["batch"], r["pass"], r["k"]) for r in M.replay(df, "k", 4, 1, 5).collect())
    assert rows == [(b, b // 3, k) for b in range(1, 6) for k in range(b % 3 * 4, min(10, b % 3 * 4 + 4))]
    assert M.replay(df.where("k < 0"), "k", 4, 0, 5).count() == 0
