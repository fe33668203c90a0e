"""Per-session operators over streams of requests, keyed by session: the state that clients of a policy server keep.

Each is a Structured Streaming operator with arbitrary state (``applyInPandasWithState``); its batch form, which gives the
same rows, is in :mod:`loomstep.operators`. State of a session that stays silent is dropped after ``idle``
milliseconds (0: never; use that with an availableNow trigger, which would wait for time-outs without end).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomstep.operators.evaluation import GripperState

IDLE_MS = 30 * 60 * 1000


def _stateful(df: DataFrame, keys: list[str], step, start, columns: str, idle: int) -> DataFrame:
    """``step(memory, row)`` gives the output values of a row and may change the memory (JSON-like); rows go in order of
    their ``t`` within a batch."""
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)
    names = [c.split()[0] for c in columns.split(", ")]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        memory = json.loads(state.get[0]) if state.exists else start()
        rows = pd.concat(list(frames)).sort_values("t")
        out = []
        for row in rows.to_dict("records"):
            out.append((*key, int(row["t"]), *step(memory, row)))
        state.update((json.dumps(memory),))
        if idle:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=[*keys, "t", *names])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout
    return df.groupBy(*keys).applyInPandasWithState(run, f"{kinds}, t long, {columns}", "memory string", "append", timeout)


def sticky_gripper(df: DataFrame, keys: list[str], hold: int, threshold: float = 0.5, opening: str = "opening", idle: int = IDLE_MS) -> DataFrame:
    def step(memory: dict, row: dict) -> tuple:
        state = GripperState(**memory)
        out = state.step(float(row[opening]), hold, threshold)
        memory |= vars(state)
        return (float(out),)

    return _stateful(df, keys, step, dict, "gripper double", idle)


def chunk_cache(df: DataFrame, keys: list[str], every: int, chunk: str = "chunk", task: str | None = None, idle: int = IDLE_MS) -> DataFrame:
    """One value of a cached chunk for each step; a new chunk every ``every`` steps, or when the task changes."""

    def step(memory: dict, row: dict) -> tuple:
        if task and memory.get("task") != row[task]:
            memory |= {"task": row[task], "n": 0}
        at = memory.setdefault("n", 0) % every
        if at == 0:
            memory["chunk"] = [float(x) for x in row[chunk]]
        memory["n"] += 1
        return (memory["chunk"][at],)

    return _stateful(df, keys, step, dict, "action double", idle)


def ensemble(df: DataFrame, keys: list[str], alpha: float, chunk: str = "chunk", idle: int = IDLE_MS) -> DataFrame:
    """The weighted mean of all cached predictions for the step; chunks leave when their last step is past. ``chunk`` is an
    array of vectors, or null for a step without a new one."""

    def step(memory: dict, row: dict) -> tuple:
        chunks, now = memory.setdefault("chunks", []), int(row["t"])
        if row[chunk] is not None:
            chunks.append([now, [[float(x) for x in v] for v in row[chunk]]])
        memory["chunks"] = chunks = [c for c in chunks if c[0] + len(c[1]) > now]
        seen = [c[1][now - c[0]] for c in chunks]
        if not seen:
            return ([],)
        newest = seen[-1]
        size = lambda v: math.sqrt(sum(x * x for x in v))
        w = [math.exp(alpha * sum(a * b for a, b in zip(v, newest)) / (size(v) * size(newest) + 1e-7)) for v in seen]
        return ([sum(a * v[d] for a, v in zip(w, seen)) / sum(w) for d in range(len(newest))],)

    return _stateful(df, keys, step, dict, "action array<double>", idle)


def delta_decode(df: DataFrame, keys: list[str], base: float, value: str = "value", idle: int = IDLE_MS) -> DataFrame:
    """Absolute actions from deltas, carried over batches."""

    def step(memory: dict, row: dict) -> tuple:
        memory["at"] = memory.get("at", base) + float(row[value])
        return (memory["at"],)

    return _stateful(df, keys, step, dict, "action double", idle)


def success_windows(df: DataFrame, time: str, success: str, width: str = "10 minutes", late: str = "5 minutes") -> DataFrame:
    """Success rates over tumbling windows of event time, with late rows waited for."""
    timed = df.withColumn("__at", F.col(time).cast("timestamp")).withWatermark("__at", late)
    return timed.groupBy(F.window("__at", width)).agg(F.count("*").alias("episodes"), F.avg(F.col(success).cast("double")).alias("rate"))
