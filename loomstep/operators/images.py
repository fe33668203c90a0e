"""Images of rows through steps on arrays, in Arrow batches. An image is a struct of its sizes and its pixels as bytes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.functions.images import Step
from loomstep.operators.mixture import hash_unit

IMAGE = "struct<height:int,width:int,channels:int,data:binary>"


def image(height: Column, width: Column, channels: Column, pixels: Column) -> Column:
    """An image from an array of its pixels, row by row."""
    data = F.unhex(F.array_join(F.transform(pixels, lambda p: F.lpad(F.hex(p), 2, "0")), ""))
    return F.struct(height.cast("int").alias("height"), width.cast("int").alias("width"), channels.cast("int").alias("channels"), data.alias("data"))


def map_views(df: DataFrame, keys: Sequence[str], views: str, steps: Sequence[Step], seed: int = 0) -> DataFrame:
    """(keys, views): the images of each row's array put through the steps together, if they are of one size, else one by one
    with the same draws. What a step draws follows from the keys, the seed and its place. A row without images has none."""
    draws = F.array(*[hash_unit(F.lit(seed), *map(F.col, keys), F.lit(k)) for k in range(len(steps))])
    own = df.select(*keys, F.coalesce(views, F.array().cast(f"array<{IMAGE}>")).alias("views"), draws.alias("__draws"))
    kind = pa.list_(pa.struct([("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("data", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for found, drawn in zip(b.column(len(keys)).to_pylist(), b.column(len(keys) + 1).to_pylist()):
                arrays = [np.frombuffer(v["data"], np.uint8).reshape(v["height"], v["width"], v["channels"]) for v in found]
                same = len({a.shape for a in arrays}) == 1
                stacks = [np.stack(arrays)] if same else [a[None] for a in arrays]
                for step, u in zip(steps, drawn):
                    stacks = [step(x, u) for x in stacks]
                out.append([{"height": y.shape[0], "width": y.shape[1], "channels": y.shape[2], "data": np.ascontiguousarray(y).tobytes()} for x in stacks for y in x])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(out, kind)], [*keys, "views"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(keys)])
    return own.mapInArrow(run, f"{fields}, views array<{IMAGE}>")


def pixels(df: DataFrame, keys: Sequence[str], views: str = "views") -> DataFrame:
    """(keys, view, y, x, channel, value): a row for each byte, for looking at results."""
    one = df.select(*keys, F.posexplode(views).alias("view", "v"))
    text = F.hex("v.data")
    values = F.transform(F.sequence(F.lit(0), F.octet_length("v.data") - 1), lambda i: F.conv(F.substr(text, i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    each = one.where(F.octet_length("v.data") > 0).select(*keys, "view", F.col("v.width").alias("w"), F.col("v.channels").alias("c"), F.posexplode(values).alias("at", "value"))
    place = F.floor(F.col("at") / F.col("c"))
    return each.select(*keys, F.col("view").cast("long").alias("view"), F.floor(place / F.col("w")).alias("y"), (place % F.col("w")).alias("x"), (F.col("at") % F.col("c")).cast("long").alias("channel"), "value")


def patch_size_columns(height: Column, width: Column, target: int, pad: bool, patch: int = 14) -> tuple[Column, Column]:
    """:func:`loomstep.functions.images.patch_sizes` as columns."""
    other = lambda side, by: (F.bround(side * (F.lit(float(target)) / by) / patch) * patch).cast("long")
    goal = F.lit(target).cast("long")
    if not pad:
        return other(height, width), goal
    tall = height > width
    return F.when(tall, goal).otherwise(other(height, width)), F.when(tall, other(width, height)).otherwise(goal)
