"""Feature transforms bound to a dataset's metadata, applied to the columns of its keys and taken back in reverse order.

A transform is a value: binding checks the configuration against the metadata on the driver and fixes the constants, and
applying only adds column expressions, so a chain of transforms stays one projection that Catalyst sees as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.functions import rotations as R
from loomstep.functions import vectors as V
from loomstep.sources.episodes import Key

# Bounds that a representation has by itself, whatever the data. Angles are in radians.
HALF_TURN = 3.141592653589793
ROTATION_BOUNDS = {
    "rotation_6d": ([-1.0] * 6, [1.0] * 6),
    "euler_angles": ([-HALF_TURN] * 3, [HALF_TURN] * 3),
    "quaternion": ([-1.0] * 4, [1.0] * 4),
    "axis_angle": ([-HALF_TURN] * 3, [HALF_TURN] * 3),
}
BOUNDS_OF = {"min_max": ("min", "max"), "scale": ("min", "max"), "q99": ("q01", "q99"), "mean_std": ("mean", "std"), "binary": None}


@dataclass(frozen=True)
class Metadata:
    """What a transform is bound to: keys by dotted name, statistics by dotted name and statistic, and the keys that are not
    continuous."""

    keys: Mapping[str, Key]
    statistics: Mapping[str, Mapping[str, Sequence[float]]]
    discrete: frozenset[str] = frozenset()


def _each(vector: Column, low: Sequence[float], high: Sequence[float], how: Callable[[Column, Column, Column], Column]) -> Column:
    """``how`` of each element with its own bounds; lambdas see only their elements."""
    bounds = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in zip(low, high, strict=True)])
    return F.zip_with(vector, bounds, lambda x, b: how(x, b["a"], b["b"]))


@dataclass(frozen=True)
class Normalizer:
    mode: str
    low: Sequence[float] | None = None
    high: Sequence[float] | None = None
    threshold: float = 0.5

    def forward(self, vector: Column) -> Column:
        if self.mode == "binary":
            return F.transform(vector, lambda x: V.normalize(x, "binary", threshold=self.threshold))
        return _each(vector, self.low, self.high, lambda x, a, b: V.normalize(x, self.mode, a, b))

    def inverse(self, vector: Column) -> Column:
        if self.mode == "binary":
            return F.transform(vector, lambda x: V.denormalize(x, "binary"))
        return _each(vector, self.low, self.high, lambda x, a, b: V.denormalize(x, self.mode, a, b))


@dataclass(frozen=True)
class StateAction:
    """Rotation, then normalisation, of some keys. Without :meth:`bind` it knows no constants and cannot be applied."""

    apply_to: Sequence[str]
    modes: Mapping[str, str] = field(default_factory=dict)
    rotations: Mapping[str, str] = field(default_factory=dict)
    threshold: float = 0.5
    turned: Mapping[str, tuple[str, str]] | None = None
    normalizers: Mapping[str, Normalizer] | None = None

    def bind(self, metadata: Metadata) -> StateAction:
        """Every key must be known, every normalised one have statistics. A key that changes its representation has the new
        one's own bounds, if it is absolute and normalised by min_max; a relative one cannot be normalised. A key that is not
        continuous is only ever binary."""
        for key in self.apply_to:
            if key.count(".") == 0 or key not in metadata.keys:
                raise KeyError(f"{key} is no known modality.key")
        turned, normalizers = {}, {}
        for key, target in self.rotations.items():
            source = metadata.keys[key].rotation
            if source is None:
                raise ValueError(f"{key} is no rotation")
            if target not in R.KINDS or source not in R.KINDS:
                raise ValueError(f"{key}: unknown representation {source} or {target}")
            if source != target:
                turned[key] = (source, target)
        for key, mode in self.modes.items():
            if key not in metadata.statistics:
                raise KeyError(f"no statistics of {key}")
            if mode not in BOUNDS_OF:
                raise ValueError(f"unknown mode: {mode}")
            if key in turned:
                if not metadata.keys[key].absolute:
                    raise ValueError(f"{key}: a relative rotation that changes its representation cannot be normalized")
                if mode != "min_max":
                    raise ValueError(f"{key}: a rotation that changes its representation is normalized by min_max only")
                kind = "euler_angles" if turned[key][1].startswith("euler_angles") else turned[key][1]
                if kind not in ROTATION_BOUNDS:
                    raise ValueError(f"{key}: {kind} has no bounds of its own")
                normalizers[key] = Normalizer(mode, *ROTATION_BOUNDS[kind])
            elif mode == "binary":
                normalizers[key] = Normalizer(mode, threshold=self.threshold)
            elif key in metadata.discrete:
                raise ValueError(f"{key} is not continuous: binary is its only mode")
            else:
                low, high = (list(metadata.statistics[key][name]) for name in BOUNDS_OF[mode])
                normalizers[key] = Normalizer(mode, low, high)
        return replace(self, turned=turned, normalizers=normalizers)

    def _steps(self, df: DataFrame, key: str) -> tuple[tuple[str, str] | None, Normalizer | None]:
        if self.turned is None:
            raise ValueError("bind the transform to metadata first")
        return self.turned.get(key), self.normalizers.get(key)

    def apply(self, df: DataFrame) -> DataFrame:
        """Keys that ``df`` has no column for are passed over."""
        out = {}
        for key in [k for k in self.apply_to if k in df.columns]:
            turn, norm = self._steps(df, key)
            value = F.col(f"`{key}`")
            value = R.convert(value, *turn) if turn else value
            out[key] = norm.forward(value) if norm else value
        return df.withColumns(out)

    def unapply(self, df: DataFrame) -> DataFrame:
        out = {}
        for key in [k for k in self.apply_to if k in df.columns]:
            turn, norm = self._steps(df, key)
            value = F.col(f"`{key}`")
            value = norm.inverse(value) if norm else value
            out[key] = R.convert(value, turn[1], turn[0]) if turn else value
        return df.withColumns(out)


@dataclass(frozen=True)
class SinCos:
    """Sines, then cosines, of some keys; there is no way back."""

    apply_to: Sequence[str]

    def bind(self, metadata: Metadata) -> SinCos:
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({k: V.sin_cos(F.col(f"`{k}`")) for k in self.apply_to if k in df.columns})


@dataclass(frozen=True)
class Concat:
    """Some keys, in order, as one vector of a modality; back, the vector is cut by the keys' sizes, which must add up."""

    name: str
    order: Sequence[str]
    sizes: Mapping[str, int] | None = None

    def bind(self, metadata: Metadata) -> Concat:
        if missing := [k for k in self.order if k not in metadata.keys]:
            raise KeyError(f"no such keys: {missing}")
        return replace(self, sizes=dict(self.sizes or {}) | {k: metadata.keys[k].end - metadata.keys[k].start for k in self.order if k not in (self.sizes or {})})

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.name, F.concat(*[F.col(f"`{k}`") for k in self.order])).drop(*self.order)

    def unapply(self, df: DataFrame) -> DataFrame:
        total = sum(self.sizes[k] for k in self.order)
        whole = F.when(F.size(self.name) == total, F.col(self.name)).otherwise(F.raise_error(F.lit(f"{self.name} has not {total} dimensions")).cast("array<double>"))
        parts = V.split_parts(whole, [(k, self.sizes[k]) for k in self.order])
        return df.withColumns(dict(zip(self.order, parts))).drop(self.name)


@dataclass(frozen=True)
class OnlyTraining:
    """A transform of training rows alone; in evaluation, and on the way back, rows pass through."""

    change: Callable[[DataFrame], DataFrame]
    training: bool = True

    def bind(self, metadata: Metadata) -> OnlyTraining:
        return self

    def apply(self, df: DataFrame) -> DataFrame:
        return self.change(df) if self.training else df


@dataclass(frozen=True)
class Compose:
    """Transforms in order; :meth:`unapply` goes through those that have an inverse, the last one first."""

    steps: Sequence

    def bind(self, metadata: Metadata) -> Compose:
        return Compose([s.bind(metadata) for s in self.steps])

    def mode(self, training: bool) -> Compose:
        return Compose([replace(s, training=training) if isinstance(s, OnlyTraining) else s for s in self.steps])

    def _run(self, df: DataFrame, steps: Sequence[tuple[int, object]], verb: str) -> DataFrame:
        for k, step in steps:
            try:
                df = getattr(step, verb)(df)
            except Exception as e:
                raise ValueError(f"{verb} of transform {k}: {e}") from e
        return df

    def apply(self, df: DataFrame) -> DataFrame:
        return self._run(df, list(enumerate(self.steps)), "apply")

    def unapply(self, df: DataFrame) -> DataFrame:
        return self._run(df, [(k, s) for k, s in reversed(list(enumerate(self.steps))) if hasattr(s, "unapply")], "unapply")


def unapply_actions(df: DataFrame, actions: str, keys: Sequence[tuple[str, int]], pipeline: Compose) -> DataFrame:
    """Policy outputs (one vector over all action keys) in the robot's own units: cut by key, taken back through the training
    pipeline, and put together again. A vector of another size ends the query."""
    cut = Concat(actions, [k for k, _ in keys], dict(keys))
    return cut.apply(pipeline.unapply(cut.unapply(df)))


def sin_cos_by_key(df: DataFrame, keys: Sequence[str], name: str = "state") -> DataFrame:
    """Every key's sines and cosines, then all keys in order: the state that a policy trained on such features is sent."""
    return df.withColumn(name, F.concat(*[V.sin_cos(F.col(f"`{k}`")) for k in keys]))
