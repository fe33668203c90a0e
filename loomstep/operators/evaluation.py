"""Evaluation logs as tables: success rates, pivots, chains, and agreement between two series of scores."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.operators.windows import running_count


def success_rate(flag: Column) -> Column:
    """0.0 where there is no episode."""
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))


def by_category(df: DataFrame, category: str, success: str) -> DataFrame:
    """Counts and rate of each category and of all together (a null category)."""
    return df.rollup(category).agg(F.count("*").alias("total"), F.sum(F.col(success).cast("long")).alias("successes"), success_rate(F.col(success)).alias("rate"))


def merge_counts(counts: DataFrame, category: str) -> DataFrame:
    """The same from files of counts."""
    out = counts.rollup(category).agg(F.sum("total_count").alias("total"), F.sum("success_count").alias("successes"))
    return out.withColumn("rate", F.try_divide(F.col("successes").cast("double"), F.col("total").cast("double")))


def macro_average(df: DataFrame, bucket: str, success: str) -> DataFrame:
    """The mean of the rates of buckets that have episodes."""
    return df.groupBy(bucket).agg(success_rate(F.col(success)).alias("rate")).agg(F.avg("rate").alias("macro"), F.count("*").alias("buckets"))


def pivot_mean(df: DataFrame, row: str, column: str, value: str, columns: Sequence) -> DataFrame:
    """Means by row and column, with the mean over the columns that have a value."""
    out = df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))
    cells = [F.col(f"`{c}`") for c in columns]
    have = sum((c.isNotNull().cast("int") for c in cells[1:]), cells[0].isNotNull().cast("int"))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cells[1:]), F.coalesce(cells[0], F.lit(0.0)))
    return out.withColumn("average", F.try_divide(total, have.cast("double")))


def episode_success(df: DataFrame, episode: Sequence[str], success: str) -> DataFrame:
    """An episode succeeds if any of its steps does."""
    return df.groupBy(*episode).agg(F.bool_or(success).alias("success"), F.count("*").alias("steps"))


def chain_length(df: DataFrame, sequence: Sequence[str], position: str, success: str) -> DataFrame:
    """Tasks in a row from the first that succeeded; positions count from 0."""
    first_failure = F.min(F.when(~F.col(success), F.col(position)))
    return df.groupBy(*sequence).agg(F.coalesce(first_failure, F.max(position) + 1).cast("long").alias("length"))


def chain_rates(lengths: DataFrame, most: int = 5) -> DataFrame:
    """Share of sequences with at least k tasks in a row, and the mean length."""
    rates = [F.avg((F.col("length") >= k).cast("double")).alias(f"rate_{k}") for k in range(1, most + 1)]
    return lengths.agg(*rates, F.avg("length").alias("mean_length"), F.count("*").alias("sequences"))


def cost_report(df: DataFrame, success: str, cost: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Success rate, mean cost, and the rate of successes that stay within the cost."""
    safe = F.col(success) & (F.col(cost) <= threshold)
    return df.groupBy(*keys).agg(success_rate(F.col(success)).alias("rate"), F.avg(cost).alias("mean_cost"), success_rate(safe).alias("safe_rate"))


def mean_of_means(df: DataFrame, keys: Sequence[str], inner: str, value: str) -> DataFrame:
    return df.groupBy(*keys, inner).agg(F.avg(value).alias("__m")).groupBy(*keys).agg(F.avg("__m").alias("mean"))


def mean_maximum_rank_violation(scores: DataFrame, name: str, real: str, simulated: str) -> DataFrame:
    """For each policy, the largest real gap to a policy that the simulation ranks the other way; averaged over policies. Among
    policies simulated higher only the worst real score matters, and among the others only the best, so both come from
    running extremes over the distinct simulated scores and no pairs are formed."""
    levels = scores.groupBy(simulated).agg(F.min(real).alias("__low"), F.max(real).alias("__high"))
    w = Window.orderBy(simulated)  # a catalogue's distinct scores, not data rows
    levels = levels.withColumn("__above", F.min("__low").over(w.rowsBetween(1, Window.unboundedFollowing)))
    levels = levels.withColumn("__below", F.max("__high").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    gaps = F.greatest(F.lit(0.0), F.col(real) - F.col("__above"), F.col("__below") - F.col(real))  # nulls are passed over
    return scores.join(levels, simulated).agg(F.avg(gaps).alias("mmrv"))


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """H with tie correction, and the degrees of freedom. Ranks come from counts per distinct value, summed in order by
    cells."""
    per = df.groupBy(value).agg(F.count("*").alias("n"))
    ranks = running_count(per, value, "n", "upto").select(value, "n", (F.col("upto") - F.col("n") + (F.col("n") + 1) / 2.0).alias("rank"))
    ties = ranks.agg(F.sum(F.pow(F.col("n").cast("double"), F.lit(3.0)) - F.col("n")).alias("ties"), F.sum("n").alias("total"))
    sums = df.join(ranks, value).groupBy(group).agg(F.sum("rank").alias("r"), F.count("*").alias("m"))
    all_of = sums.agg(F.sum(F.col("r") * F.col("r") / F.col("m")).alias("s"), F.count("*").alias("groups")).crossJoin(ties)  # one row each
    n = F.col("total").cast("double")
    h = (12.0 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / F.nullif(1 - F.col("ties") / (n * n * n - n), F.lit(0.0))
    return all_of.select(h.alias("h"), (F.col("groups") - 1).alias("df"))


def sticky_gripper(df: DataFrame, episode: Sequence[str], order: Sequence[str], opening: str, hold: int, threshold: float = 0.5) -> DataFrame:
    """Relative gripper commands that, once large enough, are held for ``hold`` steps. Each step depends on the state that
    the steps before left, so an episode is run through in order, in Arrow batches of whole episodes."""
    keys = list(episode)
    schema = df.select(*keys, *order).withColumn("gripper", F.lit(0.0)).schema

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order))
        state, out = GripperState(), []
        for x in pdf[opening]:
            out.append(state.step(float(x), hold, threshold))
        return pdf[[*keys, *order]].assign(gripper=out)

    return df.groupBy(*keys).applyInPandas(run, schema)


class GripperState:
    """The state of one episode: last reference, and a command being held with the steps it has been."""

    def __init__(self, reference: float | None = None, held: float | None = None, steps: int = 0) -> None:
        self.reference, self.held, self.steps = reference, held, steps

    def step(self, opening: float, hold: int, threshold: float) -> float:
        change = 0.0 if self.reference is None else self.reference - opening
        if self.reference is None:
            self.reference = opening
        if abs(change) > threshold and self.held is None:
            self.held, self.reference = change, opening
        if self.held is None:
            return change
        out, self.steps = self.held, self.steps + 1
        if self.steps == hold:
            self.held, self.steps = None, 0
        return out


def last_line(lines: DataFrame, pattern: str, file: str = "file", text: str = "value", position: str = "line") -> DataFrame:
    """The last matching line of each file."""
    return lines.where(F.col(text).rlike(pattern)).groupBy(file).agg(F.max_by(text, position).alias(text))


