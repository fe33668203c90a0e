"""Overlapping action chunks put together, and other per-session state, in their batch form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def adaptive_ensemble(chunks: DataFrame, episode: Sequence[str], start: str, chunk: str, alpha: float, horizon: int | None = None) -> DataFrame:
    """For every step the mean of all predictions made for it, weighted by exp(alpha x cosine to the newest). A prediction
    counts while its chunk covers the step and, with ``horizon``, while it is among the last ``horizon`` starts. Cosines and
    sums run over the dimensions in long form."""
    keys = list(episode)
    cells = chunks.select(*keys, F.col(start).alias("start"), F.posexplode(chunk).alias("ahead", "vector"))
    cells = cells.withColumn("step", F.col("start") + F.col("ahead"))
    if horizon:
        cells = cells.where(F.col("ahead") < horizon)
    newest = cells.groupBy(*keys, "step").agg(F.max_by("vector", "start").alias("newest"))
    both = cells.join(newest, [*keys, "step"])
    from loomstep.functions.vectors import cosine

    weighed = both.withColumn("w", F.exp(F.lit(alpha) * cosine(F.col("vector"), F.col("newest"))))
    each = weighed.select(*keys, "step", "w", F.posexplode("vector").alias("pos", "value"))
    return each.groupBy(*keys, "step", "pos").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))


def sessions(df: DataFrame, client: Sequence[str], order: Sequence[str], marker: str, name: str = "session") -> DataFrame:
    """A new session begins where the marker (a task's text) differs from that of the step before."""
    w = Window.partitionBy(*client).orderBy(*order)
    before = F.lag(F.struct(F.col(marker).alias("m"))).over(w)
    changed = before.isNotNull() & ~before["m"].eqNullSafe(F.col(marker))
    return df.withColumn("__c", changed.cast("int")).withColumn(name, F.sum("__c").over(w)).drop("__c")


def running_reward(df: DataFrame, episode: Sequence[str], order: Sequence[str], reward: str, every: int, how: str = "max") -> DataFrame:
    """What a wrapper of ``every`` actions per call reports: the aggregate since the episode began, at each call's end."""
    w = Window.partitionBy(*episode).orderBy(*order)
    run = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum}[how]
    at = F.row_number().over(w) - 1
    last = F.lead(F.lit(1)).over(w).isNull()
    out = df.withColumn("running", run(reward).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__at", at).withColumn("__last", last)
    return out.where((F.col("__at") % every == every - 1) | F.col("__last")).drop("__at", "__last")


def decode_actions(df: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, mode: str, base: Column, name: str = "action") -> DataFrame:
    """Absolute actions from deltas (a running sum) or from values relative to the base."""
    w = Window.partitionBy(*episode).orderBy(*order)
    if mode == "delta":
        return df.withColumn(name, base + F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if mode == "rel":
        return df.withColumn(name, base + F.col(value))
    return df.withColumn(name, F.col(value))


def history(df: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, n: int, name: str = "history") -> DataFrame:
    """The last n values, oldest first; fewer at the beginning of an episode."""
    w = Window.partitionBy(*episode).orderBy(*order).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.transform(F.collect_list(F.struct(F.col(value).alias("v"))).over(w), lambda s: s["v"]))
