"""Streams of requests in several batches give what the batch forms give on all rows."""

import pytest
from pyspark.sql import functions as F

from loomstep.operators import ensembles as N
from loomstep.operators import evaluation as E
from loomstep.operators import windows as W
from loomstep.streaming import policies as P


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    """(batch table, stream of it in three files, one per trigger)."""
    folder = str(tmp_path_factory.mktemp("stream"))
    rows = spark.range(60).selectExpr("id % 3 as s", "id div 3 as t", "cast((id * 37 % 23) / 23 as double) as opening", "cast(id % 7 as double) as value")
    rows = rows.withColumn("chunk", F.array(F.array("value", "opening"), F.array(F.col("value") + 1, F.col("opening") * 2), F.array(F.col("value") - 1, F.lit(0.5))))
    rows = rows.withColumn("at", F.timestamp_seconds(F.col("t") * 120)).cache()
    for k in range(3):
        rows.where(f"t div 7 = {k}").coalesce(1).write.mode("append").parquet(folder)
    return rows, lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def rows_of(df, *columns):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect())


def test_sticky_gripper(spark, stream, tmp_path):
    batch, live = stream
    got = run(spark, P.sticky_gripper(live(), ["s"], 4, idle=0), tmp_path, "gripper")
    assert rows_of(got, "s", "t", "gripper") == rows_of(E.sticky_gripper(batch, ["s"], ["t"], "opening", 4), "s", "t", "gripper")


def test_delta_decode(spark, stream, tmp_path):
    batch, live = stream
    got = run(spark, P.delta_decode(live(), ["s"], 10.0, idle=0), tmp_path, "decode")
    assert rows_of(got, "s", "t", "action") == rows_of(N.decode_actions(batch, ["s"], ["t"], "value", "delta", F.lit(10.0)), "s", "t", "action")


def test_chunk_cache(spark, stream, tmp_path):
    batch, live = stream
    firsts = F.transform("chunk", lambda v: F.get(v, F.lit(0)))
    got = run(spark, P.chunk_cache(live().withColumn("chunk", firsts), ["s"], 3, idle=0), tmp_path, "cache")
    assert rows_of(got, "s", "t", "action") == rows_of(W.replan(batch.withColumn("c", firsts), ["s"], ["t"], "c", 3), "s", "t", "action")


def test_ensemble(spark, stream, tmp_path):
    batch, live = stream
    got = run(spark, P.ensemble(live(), ["s"], 0.6, idle=0), tmp_path, "mean")
    want = N.adaptive_ensemble(batch, ["s"], "t", "chunk", 0.6).where("step < 20")
    flat = got.select("s", F.col("t").alias("step"), F.posexplode("action").alias("pos", "value"))
    for a, b in zip(rows_of(flat, "s", "step", "pos", "value"), rows_of(want, "s", "step", "pos", "value"), strict=True):
        assert a == pytest.approx(b)


def test_success_windows(spark, stream, tmp_path):
    batch, live = stream
    got = run(spark, P.success_windows(live().withColumn("ok", F.col("value") > 3), "at", "ok"), tmp_path, "rates", "complete")
    assert sum(r["episodes"] for r in got.collect()) == batch.count()
