"""Per-dimension statistics in long form (one row for each dimension), their pooling over datasets, and their folding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.operators.windows import raw_steps


def explode_vector(df: DataFrame, vector: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, F.posexplode(vector).alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


def long_columns(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Scalar columns as dimensions of one vector."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)]))
    return df.select(*keys, cells.alias("cell")).select(*keys, "cell.pos", "cell.value")


QUANTILES, AROUND, SKETCH = (0.01, 0.99), 0.004, 2000  # the sketch's ranks are off by at most 1 / SKETCH of the rows
FEW = 4000  # rows of a group that are all counted: AROUND is too narrow for them


def describe(long: DataFrame, keys: Sequence[str] = ("pos",), approximate: bool = False) -> DataFrame:
    """Mean, population deviation, extremes and quantiles. A first pass takes bounded sketches, of which a group's quantiles
    are known to lie between two values; a second one counts the rows below and the few values between, from which the exact
    quantiles are read. With ``approximate`` the sketches' own quantiles do."""
    plain = [F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    if approximate:
        return long.groupBy(*keys).agg(*plain, *[F.percentile_approx("value", q, 100_000).alias(f"q{round(q * 100):02}") for q in QUANTILES])
    around = [x for q in QUANTILES for x in (max(q - AROUND, 0.0), min(q + AROUND, 1.0))]
    first = long.groupBy(*keys).agg(*plain, F.count("value").alias("__n"), F.percentile_approx("value", around, SKETCH).alias("__b"))
    names = [f"__k{i}" for i in range(len(keys))]
    every = F.array("min", "max", "min", "max")
    bounds = first.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__n", F.when(F.col("__n") < FEW, every).otherwise(F.col("__b")).alias("__b"))
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & long[k].eqNullSafe(bounds[n])
    # Of each quantile: rows below its stretch count without a value, those inside with it, those above not at all.
    sides = [F.struct(F.lit(i).alias("side"), F.when(F.col("value") >= F.col("__b")[2 * i], F.col("value")).alias("v"), (F.col("value") <= F.col("__b")[2 * i + 1]).alias("in")) for i in range(len(QUANTILES))]
    cells = long.join(bounds, same).select(*names, "__n", F.explode(F.array(*sides)).alias("s")).where("s.in")
    cells = cells.groupBy(*names, "__n", F.col("s.side").alias("side"), F.col("s.v").alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(*names, "side").orderBy(F.col("v").asc_nulls_first()))
    rank = F.element_at(F.array(*map(F.lit, QUANTILES)), F.col("side") + 1) * (F.col("__n") - 1)
    cells = cells.withColumn("upto", upto).withColumn("rank", rank).where("v is not null")
    at = lambda r: F.max(F.when((F.col("upto") - F.col("c") <= r) & (r < F.col("upto")), F.col("v")))
    read = cells.groupBy(*names, "side").agg(at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high"), F.first("rank").alias("rank"))
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("rank") - F.floor("rank"))
    each = read.groupBy(*names).agg(*[F.max(F.when(F.col("side") == i, value)).alias(f"q{round(q * 100):02}") for i, q in enumerate(QUANTILES)])
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & first[k].eqNullSafe(each[n])
    return first.join(each, same, "left").select(*keys, "mean", "std", "min", "max", *[f"q{round(q * 100):02}" for q in QUANTILES])


def pooled(per_dataset: DataFrame, keys: Sequence[str], weight: str = "weight", percentiles: str = "min_max") -> DataFrame:
    """Statistics of a weighted mixture from those of its datasets; weights are renormalised within each group."""
    share = F.col(weight) / F.sum(weight).over(_by(keys))
    own = per_dataset.withColumn("__w", share)
    mean = F.sum(F.col("__w") * F.col("mean"))
    square = F.sum(F.col("__w") * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean")))
    if percentiles == "weighted_average":
        low, high = F.sum(F.col("__w") * F.col("q01")), F.sum(F.col("__w") * F.col("q99"))
    elif percentiles == "min_max":
        low, high = F.min("q01"), F.max("q99")
    else:
        raise ValueError(f"unknown percentile mixing: {percentiles}")
    return own.groupBy(*keys).agg(
        mean.alias("mean"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("std"), F.min("min").alias("min"), F.max("max").alias("max"), low.alias("q01"), high.alias("q99")
    )


def chunk_cells(steps: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, offsets: Sequence[int], mode: str, state_offset: int = 0) -> DataFrame:
    """(pos, value) of what is normalised in a mode: the values themselves (abs), or every chunk's first differences (delta)
    or distances (rel) to the state ``state_offset`` steps from its base."""
    if mode == "abs":
        return steps.select(F.lit(0).alias("pos"), F.col(value).cast("double").alias("value"))
    if mode not in ("delta", "rel"):
        raise ValueError(f"unknown mode: {mode}")
    both = raw_steps(steps, episode, order, [("action", value, offsets, "first_last"), ("state", value, [state_offset], "first_last")], {"action": (mode, "state")})
    return explode_vector(both, "action")


def mode_statistics(steps: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, offsets: Sequence[int], mode: str, state_offset: int = 0) -> DataFrame:
    """Statistics of each dimension for a mode."""
    return describe(chunk_cells(steps, episode, order, value, offsets, mode, state_offset))


def _by(keys: Sequence[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def by_key(long: DataFrame, modality: DataFrame) -> DataFrame:
    """Statistics of a whole vector cut by the [start, end) of each key, positions counted from its start."""
    cut = F.broadcast(modality)  # a handful of keys, read from one metadata file
    return long.join(cut, (long["pos"] >= cut["start"]) & (long["pos"] < cut["end"])).withColumn("pos", F.col("pos") - F.col("start")).drop("start", "end")


def fold(long: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = ("pos",)) -> DataFrame:
    """Arrays in order of position, one for each statistic."""
    got = F.array_sort(F.collect_list(F.struct(*order, *columns)))
    return long.groupBy(*keys).agg(got.alias("__all")).select(*keys, *[F.col("__all")[c].alias(c) for c in columns])


def action_mask(mode: Column) -> Column:
    """False just for binary dimensions: those are not rescaled."""
    return mode != "binary"


def histogram_of_status(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))


def frobenius_error(df: DataFrame, prediction: str, truth: str, keys: Sequence[str] = ()) -> DataFrame:
    """Norm of the difference over the number of elements."""
    gap = F.col(prediction) - F.col(truth)
    return df.groupBy(*keys).agg((F.sqrt(F.sum(gap * gap)) / F.count(gap)).alias("error"))


def masked_l1(df: DataFrame, prediction: str, truth: str, mask: str | None, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error over the cells of the mask; null where a mask is empty (see :func:`require`)."""
    gap = F.abs(F.col(prediction) - F.col(truth))
    m = F.col(mask).cast("double") if mask else F.lit(1.0)
    return df.groupBy(*keys).agg(F.try_divide(F.sum(gap * m), F.nullif(F.sum(m), F.lit(0.0))).alias("loss"))


def require(df: DataFrame, holds: Column, message: str) -> DataFrame:
    """Passes rows through; a row for which the condition does not hold ends the query with the message."""
    return df.where(F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
