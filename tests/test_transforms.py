"""Bound transforms and position ids, by plain Python versions."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstep.functions import positions as P
from loomstep.functions import vectors as V
from loomstep.operators import mixture as M
from loomstep.operators import stats as S
from loomstep.operators import transforms as T
from loomstep.operators import windows as W
from loomstep.sources.episodes import Key

KEYS = {k.dotted: k for k in (Key("state", "arm", "s", 0, 2), Key("state", "turn", "s", 2, 5, rotation="axis_angle"), Key("state", "hand", "s", 5, 6))}
STATS = {"state.arm": {"min": [0, -4], "max": [10, 4], "q01": [1, -3], "q99": [9, 3], "mean": [5, 0], "std": [2, 0]}, "state.turn": {n: [0, 0, 0] for n in ("min", "max", "q01", "q99", "mean", "std")}, "state.hand": {"min": [0], "max": [1]}}
META = T.Metadata(KEYS, STATS, frozenset({"state.hand"}))


@pytest.fixture(scope="module")
def states(spark):
    return spark.createDataFrame([(1, [2.0, 4.0], [0.3, -0.2, 0.9], [0.7]), (2, [12.0, 0.0], [0.0, 0.1, 0.0], [0.2])], "i int, `state.arm` array<double>, `state.turn` array<double>, `state.hand` array<double>")


def test_binding_checks_the_configuration():
    ok = T.StateAction(list(KEYS), {"state.arm": "q99", "state.turn": "min_max", "state.hand": "binary"}, {"state.turn": "rotation_6d"}).bind(META)
    assert ok.normalizers["state.turn"].low == [-1.0] * 6 and ok.normalizers["state.arm"].high == [9, 3]
    euler = replace(ok, rotations={"state.turn": "euler_angles_xyz"}).bind(META)
    assert euler.normalizers["state.turn"].high == pytest.approx([math.pi] * 3)
    wrong = [
        (KeyError, T.StateAction(["state.leg"])), (KeyError, T.StateAction([], {"state.leg": "q99"})), (ValueError, T.StateAction([], {"state.arm": "odd"})),
        (ValueError, T.StateAction([], {}, {"state.arm": "quaternion"})), (ValueError, T.StateAction([], {}, {"state.turn": "odd"})),
        (ValueError, T.StateAction([], {"state.turn": "q99"}, {"state.turn": "quaternion"})), (ValueError, T.StateAction([], {"state.hand": "min_max"})),
        (ValueError, T.StateAction([], {"state.turn": "min_max"}, {"state.turn": "matrix"})),
    ]
    for error, t in wrong:
        with pytest.raises(error):
            t.bind(META)
    relative = T.Metadata({**KEYS, "state.turn": replace(KEYS["state.turn"], absolute=False)}, STATS)
    with pytest.raises(ValueError, match="relative"):
        T.StateAction([], {"state.turn": "min_max"}, {"state.turn": "quaternion"}).bind(relative)


def test_apply_and_back(states):
    t = T.StateAction(["state.arm", "state.turn", "state.hand", "state.arm"], {"state.arm": "min_max", "state.turn": "min_max", "state.hand": "binary"}, {"state.turn": "rotation_6d"}).bind(META)
    there = t.apply(states)
    row = there.where("i = 1").first()
    assert row["state.arm"] == pytest.approx([-0.6, 1.0]) and len(row["state.turn"]) == 6 and row["state.hand"] == [1.0]
    for a, b in zip(states.orderBy("i").collect(), t.unapply(there).orderBy("i").collect()):
        assert b["state.arm"] == pytest.approx(a["state.arm"]) and b["state.turn"] == pytest.approx(a["state.turn"])
    assert t.apply(states.drop("state.turn")).columns == ["i", "state.arm", "state.hand"]
    with pytest.raises(ValueError, match="bind"):
        T.StateAction(["state.arm"]).apply(states)


def test_composition(states):
    shift = T.OnlyTraining(lambda df: df.withColumn("state.arm", F.transform("`state.arm`", lambda x: x + 1)))
    p = T.Compose([shift, T.StateAction(["state.arm"], {"state.arm": "mean_std"}), T.Concat("all", ["state.hand", "state.arm"])]).bind(META)
    assert p.apply(states).where("i = 1").first()["all"] == pytest.approx([0.7, -1.0, 5.0])  # a flat dimension passes
    calm = p.mode(training=False)
    assert calm.apply(states).where("i = 1").first()["all"] == pytest.approx([0.7, -1.5, 4.0])
    back = calm.unapply(calm.apply(states)).orderBy("i").collect()
    assert [r["state.arm"] for r in back] == [[2.0, 4.0], [12.0, 0.0]] and back[0]["state.hand"] == [0.7]
    sizes = [("state.hand", 1), ("state.arm", 2)]
    assert T.unapply_actions(calm.apply(states), "all", sizes, T.Compose(calm.steps[:-1])).orderBy("i").first()["all"] == pytest.approx([0.7, 2.0, 4.0])
    with pytest.raises(Exception, match="3 dimensions"):
        T.unapply_actions(states.withColumn("all", F.array(F.lit(1.0))), "all", sizes, T.Compose([])).collect()
    with pytest.raises(ValueError, match="transform 0"):
        T.Compose([T.StateAction(["state.arm"])]).apply(states)


def test_sin_cos_state(states):
    keys = ["state.arm", "state.turn"]
    got = T.sin_cos_by_key(states, keys).where("i = 2").first()
    want = [f(x) for k in keys for f in (math.sin, math.cos) for x in got[k]]
    assert got["state"] == pytest.approx(want)


def plain_positions(tokens, images, videos, rates, image_rate):
    """Token by token, by the rule as it is worded."""
    out, at, following, i, v = [], 0, 0, 0, 0
    while at < len(tokens):
        if at and tokens[at - 1] == P.VISION_START and tokens[at] in (P.IMAGE, P.VIDEO):
            if tokens[at] == P.IMAGE:
                (t, h, w), rate, i = images[i], image_rate, i + 1
            else:
                (t, h, w), rate, v = videos[v], rates[v], v + 1
            h, w = h // 2, w // 2
            cells = [(following + int(a * rate), following + b, following + c) for a in range(t) for b in range(h) for c in range(w)]
            out += cells
            at, following = at + len(cells), max(map(max, cells)) + 1
        else:
            out.append((following,) * 3)
            at, following = at + 1, following + 1
    return out


@pytest.mark.parametrize("version", ["frames", "seconds", "index"])
def test_position_ids(spark, version):
    rng, rows, wants = np.random.default_rng(5), [], []
    for _ in range(25):
        tokens, images, videos, rates = [1] * int(rng.integers(0, 3)), [], [], []
        for _ in range(int(rng.integers(0, 4))):
            t, h, w = int(rng.integers(1, 4)), 2 * int(rng.integers(1, 4)), 2 * int(rng.integers(1, 4))
            if rng.random() < 0.5:
                images.append([1, h, w])
                tokens += [P.VISION_START] + [P.IMAGE] * (h * w // 4) + [9] * int(rng.integers(1, 4))
            else:
                videos.append([t, h, w])
                rates.append(float(rng.choice([0.25, 0.5, 1.0])))
                parts = [1] * t if version == "frames" else [t]
                for n in parts:
                    tokens += [P.VISION_START] + [P.VIDEO] * (n * h * w // 4) + [9]
        rows.append((len(rows), tokens, images, videos, rates))
        if version == "frames":
            wants.append(plain_positions(tokens, images, [[1, h, w] for t, h, w in videos for _ in range(t)], [0.0] * 99, 0.0))
        else:
            wants.append(plain_positions(tokens, images, videos, [2 * r for r in rates] if version == "seconds" else [1.0] * 99, 1.0 if version == "index" else 0.0))
    df = spark.createDataFrame(rows, "i int, ids array<int>, images array<array<int>>, videos array<array<int>>, seconds array<double>")
    got = df.select("i", P.position_ids(F.col("ids"), F.col("images"), F.col("videos"), version, 2, F.col("seconds")).alias("p")).collect()
    for r in got:
        assert list(zip(r["p"]["t"], r["p"]["h"], r["p"]["w"])) == wants[r["i"]]


def test_exact_quantiles(spark):
    """Large, small, tied, single and empty groups, against numpy."""
    rng = np.random.default_rng(8)
    groups = {"large": rng.lognormal(0, 4, 30_000), "small": rng.normal(size=7), "tied": rng.integers(0, 3, 9000).astype(float), "one": np.array([4.0])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v] + [("none", None), (None, 1.0), (None, 3.0)]
    got = {r["k"]: r for r in S.describe(spark.createDataFrame(rows, "k string, value double").repartition(5), ["k"]).collect()}
    for k, v in groups.items():
        assert (got[k]["q01"], got[k]["q99"]) == pytest.approx(tuple(np.quantile(v, [0.01, 0.99]))) and got[k]["mean"] == pytest.approx(v.mean())
    assert got["none"]["q01"] is None and got[None]["q99"] == pytest.approx(2.98)


def test_running_counts_over_cells(spark):
    rng = np.random.default_rng(9)
    values = np.unique(rng.lognormal(0, 5, 3000))
    df = spark.createDataFrame([(float(v), int(n)) for v, n in zip(values, rng.integers(1, 9, len(values)))], "v double, n long")
    rows = W.running_count(df, "v", "n", "upto", cells=16).orderBy("v").collect()
    assert [r["upto"] for r in rows] == np.cumsum([r["n"] for r in rows]).tolist()


def test_hierarchical_draw_finds_every_index(spark):
    """Shares whose running sum falls short of 1, and a dataset with one episode: no index is lost, and each gets the row
    whose range holds its numbers."""
    d = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.7 - 1e-3)], "dataset string, share double")
    e = spark.createDataFrame([("a", 1, 0.5, 4), ("a", 2, 0.5, 2), ("b", 3, 1.0, 9), ("c", 4, 0.3, 1), ("c", 5, 0.0, 5), ("c", 6, 0.7, 3)], "dataset string, episode int, share double, steps int")
    got = M.hierarchical_draw(spark.range(4000).withColumnRenamed("id", "index"), d, e, 0, 1).toPandas()
    assert sorted(got["index"]) == list(range(4000)) and 5 not in set(got["episode"])
    steps = {r["episode"]: r["steps"] for r in e.collect()}
    assert all(0 <= s < steps[k] for s, k in zip(got["step"], got["episode"]))
    assert abs((got["dataset"] == "b").mean() - 0.2) < 0.03 and abs((got["episode"] == 1).mean() - 0.05) < 0.02


def test_perturbation(spark):
    v = F.array(*[F.lit(float(x)) for x in range(200)])
    rows = spark.range(50).select(M.perturb(v, 2.0, F.lit(3), F.col("id")).alias("a")).collect()
    gaps = np.array([r["a"] for r in rows]) - np.arange(200)
    inner = gaps[:, 10:-10]
    assert abs(inner.mean()) < 0.1 and abs(inner.std() - 2) < 0.1 and abs(np.corrcoef(inner[:, 0], inner[:, 1])[0, 1]) < 0.5
    assert min(min(r["a"]) for r in rows) >= 0 and max(max(r["a"]) for r in rows) <= 199
    zeros = spark.range(2000).select(M.drop_out(F.array(F.lit(1.0), F.lit(2.0)), 0.25, F.col("id")).alias("a")).collect()
    assert {tuple(r["a"]) for r in zeros} == {(0.0, 0.0), (1.0, 2.0)} and abs(sum(r["a"][0] == 0 for r in zeros) / 2000 - 0.25) < 0.04


def test_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c")], "k int, t int, v string")
    assert {r["k"]: r["l"] for r in V.latest(df, ["k"], ["t"], "v", "l").collect()} == {1: "b", 2: "c"}
