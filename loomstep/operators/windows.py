"""Look-ahead and look-back gathers inside episodes. All offsets of a call share one window, hence one exchange and sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def episode_window(episode: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*episode).orderBy(*order)


def offset_value(value: str, k: int, w: WindowSpec, whole: WindowSpec, padding: str) -> Column:
    """The value k steps on. Beyond the episode: its first or last value (first_last), or zero."""
    moved = F.lead(value, k).over(w) if k >= 0 else F.lag(value, -k).over(w)
    if padding == "zero":
        here = F.row_number().over(w) + k
        return F.when((here < 1) | (here > F.count(F.lit(1)).over(whole)), F.lit(0.0)).otherwise(moved)
    if padding != "first_last":
        raise ValueError(f"unknown padding: {padding}")
    return F.coalesce(moved, F.last(value).over(whole) if k >= 0 else F.first(value).over(whole))


def chunk(df: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, offsets: Sequence[int], padding: str = "first_last", name: str = "chunk") -> DataFrame:
    """Adds an array with the values at ``offsets`` from each row of its episode."""
    w = episode_window(episode, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.array(*[offset_value(value, k, w, whole, padding) for k in offsets]))


def chunk_by_position(df: DataFrame, episode: Sequence[str], order: Sequence[str], value: str, offsets: Sequence[int], name: str = "chunk") -> DataFrame:
    """The same with first_last padding for long horizons: one frame per row holds the stretch between the outermost
    offsets, and the chunk is read from it, so the width of the plan does not grow with the horizon. Offsets in a row are one
    slice of the frame with its ends repeated."""
    w = episode_window(episode, order)
    low, high, n = min(0, *offsets), max(0, *offsets), len(offsets)
    frame = F.collect_list(F.struct(F.col(value).alias("v"))).over(w.rowsBetween(low, high))
    out = df.withColumn("__at", F.row_number().over(w) - 1).withColumn("__seen", frame)
    before = F.least(F.col("__at"), F.lit(-low))
    if list(offsets) == list(range(offsets[0], offsets[0] + n)):
        first, size = before + offsets[0], F.size("__seen")
        front = F.greatest(F.lit(0), F.least(F.lit(n), -first))
        own = F.greatest(F.lit(0), F.least(n - front, size - F.greatest(first, F.lit(0))))
        got = F.concat(F.array_repeat(F.get("__seen", F.lit(0)), front), F.slice("__seen", F.greatest(first, F.lit(0)) + 1, own), F.array_repeat(F.element_at("__seen", -1), n - front - own))
        return out.withColumn(name, got).withColumn(name, F.col(name)["v"]).drop("__at", "__seen")
    place = lambda k: F.greatest(F.lit(0), F.least(before + k, F.size("__seen") - 1))
    return out.withColumn(name, F.array(*[F.get("__seen", place(k))["v"] for k in offsets])).drop("__at", "__seen")


def complete_bases(df: DataFrame, position: str, length: str, offsets: Sequence[int]) -> DataFrame:
    """Rows from which every offset stays inside the episode."""
    return df.where((F.col(position) >= max(0, -min(offsets))) & (F.col(position) < F.col(length) - max(0, max(offsets))))


def delta_chunk(chunk_col: Column, state: Column) -> Column:
    """First differences; the first one is to the state."""
    return F.transform(chunk_col, lambda a, i: a - F.when(i == 0, state).otherwise(F.get(chunk_col, i - 1)))


def relative_chunk(chunk_col: Column, state: Column) -> Column:
    return F.transform(chunk_col, lambda a: a - state)


def undelta_chunk(chunk_col: Column, state: Column) -> Column:
    """The running sum from the state: inverse of :func:`delta_chunk`."""
    grown = F.aggregate(chunk_col, F.array(state), lambda seen, d: F.concat(seen, F.array(F.element_at(seen, -1) + d)))
    return F.slice(grown, F.lit(2), F.size(chunk_col))


def even_history(frames: Column, m: int) -> Column:
    """m - 1 frames spread evenly from the first on, and the last one."""
    n = F.size(frames)
    spread = F.transform(F.sequence(F.lit(0), F.lit(m - 2)), lambda i: F.get(frames, F.floor(i * (n - 1) / F.lit(float(m - 1))).cast("int")))
    return F.concat(spread, F.array(F.element_at(frames, -1)))


def even_places(length: Column, m: int) -> list[Column]:
    """The places of :func:`even_history`'s frames in an episode of that length: rows can be picked without an array of all."""
    return [F.floor(F.lit(i) * (length - 1) / F.lit(float(m - 1))).cast("long") for i in range(m - 1)] + [(length - 1).cast("long")]


def history_offsets(k: int, stride: int) -> list[int]:
    return [-stride * i for i in range(k, 0, -1)]


def check_offsets(offsets: Sequence[int], horizon: int) -> None:
    """At most 0, ending at 0, with one positive stride."""
    steps = {b - a for a, b in zip(offsets, offsets[1:])}
    if len(offsets) != horizon or offsets[-1] != 0 or len(steps) > 1 or any(s <= 0 for s in steps):
        raise ValueError(f"offsets {list(offsets)} are no evenly spaced history of {horizon} steps")


def running_offset(df: DataFrame, length: str, order: Sequence[str], name: str = "offset", by: Sequence[str] = (), width: int = 1 << 16) -> DataFrame:
    """The sum of the lengths before each row. Over a whole table ordered by a whole number, stretches of ``width`` numbers
    are summed first, so one window runs over the stretches and one within each, and none over all rows."""
    if by:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumn(name, F.sum(length).over(w) - F.col(length))
    own = df.withColumn("__s", F.floor(F.col(order[0]) / F.lit(width)))
    sums = own.groupBy("__s").agg(F.sum(length).alias("__n"))
    before = sums.select("__s", (F.sum("__n").over(Window.orderBy("__s")) - F.col("__n")).alias("__before"))
    within = F.sum(length).over(Window.partitionBy("__s").orderBy(*order)) - F.col(length)
    return own.withColumn(name, within).join(before, "__s").withColumn(name, F.col(name) + F.col("__before")).drop("__s", "__before")


def place_in_order(df: DataFrame, key: str, name: str = "place") -> DataFrame:
    """Row numbers from 0 by a whole-number key without repeats."""
    return running_offset(df.withColumn("__one", F.lit(1).cast("long")), "__one", [key], name).drop("__one")


def replan(df: DataFrame, episode: Sequence[str], order: Sequence[str], chunk_col: str, every: int, name: str = "action") -> DataFrame:
    """A chunk is fetched every ``every`` steps and read one by one in between."""
    w = episode_window(episode, order)
    at = F.row_number().over(w) - 1
    fresh = F.when(at % every == 0, F.col(chunk_col))
    return df.withColumn(name, F.get(F.last(fresh, ignorenulls=True).over(w), at % every))


def raw_steps(df: DataFrame, episode: Sequence[str], order: Sequence[str], keys: Sequence[tuple[str, str, Sequence[int], str]], modes: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Every base step with what it takes of each modality: keys are (name, column, offsets, padding), all over one window.
    ``modes`` has, for an action key, (delta or rel, state key): the action's rows then count from the state's last one."""
    w = episode_window(episode, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = [F.array(*[offset_value(column, k, w, whole, padding) for k in offsets]).alias(name) for name, column, offsets, padding in keys]
    out = df.select(*episode, *order, *cells)
    for key, (mode, state) in (modes or {}).items():
        base = F.element_at(f"`{state}`", -1)
        out = out.withColumn(key, delta_chunk(F.col(f"`{key}`"), base) if mode == "delta" else relative_chunk(F.col(f"`{key}`"), base))
    return out


def running_count(df: DataFrame, value: str, count: str, name: str, cells: int = 256) -> DataFrame:
    """The sum of the counts of all values up to each row's, for rows of distinct values. Values are cut into cells at
    approximate quantiles (the driver holds as many numbers); sums run over the cells and within each, never over all rows, and
    are exact wherever the cuts are."""
    edges = df.approxQuantile(value, [k / cells for k in range(1, cells)], 0.2 / cells) if cells > 1 else []
    edge = F.array(*[F.lit(float(e)) for e in sorted(set(edges))]).cast("array<double>")
    own = df.withColumn("__cell", F.aggregate(edge, F.lit(0), lambda n, e: n + (e <= F.col(value)).cast("int")))
    sums = own.groupBy("__cell").agg(F.sum(count).alias("__n"))
    before = sums.select("__cell", (F.sum("__n").over(Window.orderBy("__cell")) - F.col("__n")).alias("__before"))
    within = F.sum(count).over(Window.partitionBy("__cell").orderBy(value))
    return own.withColumn(name, within).join(before, "__cell").withColumn(name, F.col(name) + F.col("__before")).drop("__cell", "__before")
