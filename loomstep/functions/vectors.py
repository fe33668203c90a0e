"""Column functions over scalars and vectors (arrays of doubles): normalisation, slicing, binning, schedules.

All are compositions of built-in expressions, so they stay inside the JVM and, for scalar columns, inside generated code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bound of quantile-normalised values; shift and greatest step of the cosine schedule.
CLAMP = 2.2
COSINE_SHIFT, MOST_BETA = 0.008, 0.999
STATS = ("min", "max", "mean", "std", "q01", "q99")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))


def normalize(x: Column, mode: str, low: Column | None = None, high: Column | None = None, threshold: float = 0.5) -> Column:
    """One value. low and high are q01 and q99, mean and std, or min and max, as the mode asks."""
    if mode == "q99":
        return clamp(F.when(low == high, x).otherwise(2 * (x - low) / F.nullif(high - low, F.lit(0.0)) - 1), -CLAMP, CLAMP)
    if mode == "mean_std":
        return F.when(high == 0, x).otherwise((x - low) / F.nullif(high, F.lit(0.0)))
    if mode == "min_max":
        return F.when(low == high, F.lit(0.0)).otherwise(2 * (x - low) / F.nullif(high - low, F.lit(0.0)) - 1)
    if mode == "scale":
        most = F.greatest(F.abs(low), F.abs(high))
        return F.coalesce(F.try_divide(x, most), F.lit(0.0))
    if mode == "binary":
        return (x > threshold).cast("double")
    raise ValueError(f"unknown mode: {mode}")


def denormalize(y: Column, mode: str, low: Column | None = None, high: Column | None = None) -> Column:
    """The inverse where there is one: nothing is clamped, and a constant dimension gives its constant."""
    if mode in ("q99", "min_max"):
        return (y + 1) / 2 * (high - low) + low
    if mode == "mean_std":
        return F.when(high == 0, y).otherwise(y * high + low)
    if mode == "binary":
        return (y > 0.5).cast("double")
    raise ValueError(f"no inverse for mode: {mode}")


def legacy_denormalize(y: Column, low: Column, high: Column, masked: Column, is_gripper: Column) -> Column:
    """Clipped to [-1, 1]; the gripper becomes 0 or 1 at one half; masked dimensions are rescaled linearly."""
    y = clamp(y, -1, 1)
    y = F.when(is_gripper, F.when(y < 0.5, 0.0).otherwise(1.0)).otherwise(y)
    return F.when(masked, 0.5 * (y + 1) * (high - low) + low).otherwise(y)


def linear_fit(mode: str, low: Column, high: Column, mean: Column, std: Column, to: tuple[float, float] = (-1.0, 1.0), eps: float = 1e-4, offset: bool = True) -> tuple[Column, Column]:
    """(scale, offset) of a linear normaliser; ``std`` is the sample deviation."""
    bottom, top = to
    if mode == "gaussian":
        scale = 1 / F.when(std < eps, 1.0).otherwise(std)
        return scale, -mean * scale if offset else F.lit(0.0)
    if mode != "limits":
        raise ValueError(f"unknown mode: {mode}")
    if not offset:
        unit, most = min(abs(bottom), abs(top)), F.greatest(F.abs(low), F.abs(high))
        return unit / F.when(most < eps, unit).otherwise(most), F.lit(0.0)
    flat = (high - low) < eps
    scale = (top - bottom) / F.when(flat, top - bottom).otherwise(high - low)
    return scale, F.when(flat, (top + bottom) / 2 - low).otherwise(bottom - scale * low)


def part(vector: Column, start: int, end: int) -> Column:
    """Elements [start, end), counted from 0."""
    return F.slice(vector, start + 1, end - start)


def split_parts(vector: Column, sizes: Sequence[tuple[str, int]]) -> list[Column]:
    """Consecutive groups of a vector under their names."""
    out, at = [], 0
    for name, size in sizes:
        out.append(part(vector, at, at + size).alias(name))
        at += size
    return out


def sin_cos(vector: Column) -> Column:
    return F.concat(F.transform(vector, F.sin), F.transform(vector, F.cos))


def scatter(vector: Column, at: int, width: int, size: int) -> Column:
    """``vector`` of ``size`` elements at place ``at`` of a zero vector of ``width``."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    return F.concat(zeros(at), vector, zeros(width - at - size))


def last_of(vectors: Column) -> Column:
    return F.try_element_at(vectors, F.lit(-1))


def latest(df: DataFrame, keys: Sequence[Column | str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """The value of each key's newest row, without gathering its history."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


def tail(vectors: Column, n: int) -> Column:
    """The last n elements, or all if there are fewer."""
    size = F.size(vectors)
    return F.slice(vectors, F.greatest(size - n + 1, F.lit(1)), F.lit(n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-7) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))


def to_bin(x: Column, bins: int, low: float = -1.0, high: float = 1.0, eps: float = 1e-6) -> Column:
    """Uniform bins over [low, high]; values are clamped to just inside."""
    unit = clamp((x - low) / (high - low), eps, 1 - eps)
    return F.floor(unit * bins)


def bin_center(index: Column, bins: int, low: float = -1.0, high: float = 1.0) -> Column:
    return (index + 0.5) * ((high - low) / bins) + low


def bits(index: Column, width: int = 8) -> Column:
    """Lowest bit first."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.call_function("shiftright", index.cast("int"), i).bitwiseAND(F.lit(1)))


def state_tokens(vector: Column, bins: int = 256) -> Column:
    """Bin numbers over [-1, 1] as text. Values below the range give -1; those above the last edge, the last bin."""
    place = lambda v: F.when(v < -1, F.lit(-1)).otherwise(F.least(F.floor((v + 1) / 2 * bins), F.lit(bins - 1)))
    return F.array_join(F.transform(vector, lambda v: place(v).cast("string")), " ")


def train_mask_ratio(t: Column, method: str = "cosine") -> Column:
    return clamp(1 - F.cos(t * (math.pi / 2)) if method == "cosine" else t, 1e-6, 1.0)


def decode_mask_ratio(r: Column, method: str = "cosine") -> Column:
    return 0.5 * (1 + F.cos(r * math.pi)) if method == "cosine" else 1 - r


def beta_schedule(t: Column, kind: str, steps: int, start: float = 1e-4, end: float = 0.02) -> Column:
    """The noise level of step t (from 0) out of ``steps``."""
    along = t / float(max(steps - 1, 1))
    if kind == "linear":
        return start + (end - start) * along
    if kind == "quad":
        return F.pow(math.sqrt(start) + (math.sqrt(end) - math.sqrt(start)) * along, F.lit(2.0))
    if kind in ("warmup10", "warmup50"):
        n = int(steps * {"warmup10": 0.1, "warmup50": 0.5}[kind])
        return F.when(t < n, start + (end - start) * t / float(max(n - 1, 1))).otherwise(F.lit(end))
    if kind == "const":
        return F.lit(end) + 0 * t
    if kind == "jsd":
        return 1.0 / (steps - t)
    if kind == "cosine":
        bar = lambda u: F.pow(F.cos((u + COSINE_SHIFT) / (1 + COSINE_SHIFT) * math.pi / 2), F.lit(2.0))
        return F.least(1 - bar((t + 1) / float(steps)) / bar(t / float(steps)), F.lit(MOST_BETA))
    raise ValueError(f"unknown schedule: {kind}")


def project(a: Column, v: Column, eps: float = 1e-6) -> Column:
    """``v`` without what works against ``a``: where their product is negative, its part along ``a`` is taken away."""
    pull = dot(a, v) / (dot(a, a) + F.lit(eps))
    along = F.array_repeat(F.least(pull, F.lit(0.0)), F.size(v))  # found once, not for each element
    return F.zip_with(v, F.zip_with(a, along, lambda x, c: x.cast("double") * c), lambda y, d: y.cast("double") - d)


def argmax(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)) - 1


def fit_rows(rows: Column, n: int, columns: int) -> Column:
    """The last n rows of a matrix cut to ``columns``; missing rows in front repeat the first one kept, missing columns are 0."""
    own = F.transform(tail(rows, n), lambda r: F.concat(F.slice(r, F.lit(1), F.least(F.size(r), F.lit(columns))), F.array_repeat(F.lit(0.0), F.greatest(F.lit(columns) - F.size(r), F.lit(0)))))
    return F.concat(F.array_repeat(F.get(own, F.lit(0)), F.lit(n) - F.size(own)), own)


def fit_mask(rows: Column, n: int, columns: int) -> Column:
    """True where :func:`fit_rows` holds a value of the matrix itself."""
    own = tail(rows, n)
    line = lambda k: F.concat(F.array_repeat(F.lit(True), F.least(k, F.lit(columns))), F.array_repeat(F.lit(False), F.greatest(F.lit(columns) - k, F.lit(0))))
    return F.concat(F.array_repeat(F.array_repeat(F.lit(False), columns), F.lit(n) - F.size(own)), F.transform(own, lambda r: line(F.size(r))))


def all_finite(rows: Column) -> Column:
    return ~F.exists(rows, lambda r: F.exists(r, lambda v: F.isnan(v) | (F.abs(v) == float("inf")) | v.isNull()))
