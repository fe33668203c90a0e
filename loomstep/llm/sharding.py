"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by three longs: hash of the text, hash of the id, the row's number. Splitters come from counting: each round
takes, in one hash aggregate over all partitions, the exact bytes below a few candidate boundaries for every splitter that is
still open, and narrows the interval to the bucket that holds the target and to the values seen in it. A splitter is final when
the bytes below it are within the tolerance of its target. Where its interval has come down to a single text hash, a group of
equal texts lies across the target: the boundary goes to the group's nearer end if that leaves the shards within ``together`` of
their size, and only else the search goes on inside the group, by id hash and then by row, so that a group of any size can be
cut. Then rows are exchanged once. The driver only ever holds (shards - 1) x (probes + 1) counts.

Defined results: a null text has size 1 (no bytes, plus one) and hashes as a value of its own; null ids and repeated rows are
told apart by row number; extra columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, new_path, utf8_size, written

SHARDS, PROBES, TOLERANCE, TOGETHER = 8, 15, 0.0005, 0.01
ORDER = ("h", "g", "row")
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.lit(1), F.col(text_col))


def id_hash(id_col: str) -> Column:
    return F.xxhash64(F.lit(2), F.col(id_col))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, text_crc32, h, g, row) as a written table, which fixes the row numbers."""
    own = df.select(
        F.col(id_col).alias("id"),
        (utf8_size(F.col(text_col)) + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        text_hash(text_col).alias("h"),
        id_hash(id_col).alias("g"),
        F.monotonically_increasing_id().alias("row"),
    )
    return written(own, "shard-keys")


@dataclass
class _Open:
    """A splitter in search: the wanted bytes, the interval of values [low, high], the exact bytes below low, and, once the
    interval is a single value, that value's bytes and rows. ``bound`` is the first value above the splitter."""

    wanted: float
    low: int
    high: int
    below: int
    single: tuple[int, int] | None = None
    bound: int | None = None


def _narrow(keys: DataFrame, column: str, spots: list[_Open], probes: int, slack: float) -> None:
    """Counts until every splitter has a bound or is down to a single value."""
    while still := [s for s in spots if s.bound is None and s.single is None]:
        edges = {x for s in still for x in (s.low, s.high + 1)}
        edges |= {s.low + (s.high + 1 - s.low) * k // (probes + 1) for s in still for k in range(1, probes + 1)}
        bucket = F.lit(0)
        for x in sorted(e for e in edges if e <= MOST):
            bucket = bucket + (F.lit(x) <= F.col(column)).cast("int")
        there = F.lit(False)
        for low, high in {(s.low, s.high) for s in still}:
            there = there | F.col(column).between(low, high)
        seen = keys.where(there).groupBy(bucket.alias("bucket")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))
        buckets = sorted((r["low"], r["high"], r["bytes"], r["rows"]) for r in seen.collect())
        for s in still:
            mine = [b for b in buckets if s.low <= b[0] <= s.high]
            for low, high, size, rows in mine:
                if s.below + size > s.wanted or (low, high, size, rows) == mine[-1]:
                    under, over = s.wanted - s.below, s.below + size - s.wanted
                    if under <= slack:
                        s.bound = low
                    elif over <= slack:
                        s.bound = high + 1
                    elif low == high:
                        s.low, s.single = low, (size, rows)
                    else:
                        s.low, s.high = low, high
                    break
                s.below += size


def splitters(keys: DataFrame, shards: int = SHARDS, probes: int = PROBES, tolerance: float = TOLERANCE, together: float = TOGETHER) -> list[tuple[int, ...]]:
    """The shards - 1 boundaries, each the first values of (h, g, row) above it: a row's shard is the number of boundaries at
    or below its own values."""
    total = keys.agg(F.sum("size")).first()[0]
    if total is None:
        return []
    slack, out = tolerance * total / shards, []

    def search(rows: DataFrame, depth: int, wanted: list[float], below: int, prefix: tuple[int, ...]) -> None:
        spots = [_Open(w, LEAST, MOST, below) for w in wanted]
        _narrow(rows, ORDER[depth], spots, probes, slack)
        deeper: dict[int, list[_Open]] = {}
        for s in spots:
            if s.single is not None:
                size, count = s.single
                under, over = s.wanted - s.below, s.below + size - s.wanted
                if count > 1 and depth + 1 < len(ORDER) and min(under, over) > together * total / shards:
                    deeper.setdefault(s.low, []).append(s)
                    continue
                s.bound = s.low if under <= over else s.low + 1
            out.append((*prefix, s.bound))
        for value, inside in deeper.items():
            search(rows.where(F.col(ORDER[depth]) == value), depth + 1, [s.wanted for s in inside], inside[0].below, (*prefix, value))

    search(keys, 0, [total * k / shards for k in range(1, shards)], 0, ())
    return sorted(out)


def shard_of(bounds: list[tuple[int, ...]], columns: tuple[Column, ...]) -> Column:
    """The number of bounds at or below the columns, compared in order."""
    out = F.lit(0)
    for bound in bounds:
        reached = F.lit(bound[-1] <= MOST) & (columns[len(bound) - 1] >= F.lit(min(bound[-1], MOST)))
        for value, column in reversed(list(zip(bound[:-1], columns))):
            reached = (column > F.lit(value)) | (column == F.lit(value)) & reached
        out = out + reached.cast("int")
    return out


def sharded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE, cell_rows: int = 1 << 16) -> DataFrame:
    """(id, size, text_crc32, shard, slot): slots count from 0 without gaps in each shard.

    A shard is numbered cell by cell, a cell being its rows from one stretch of the input, so no task holds a whole shard.
    """
    keys = keyed(df, id_col, text_col)
    cell = F.floor(F.col("row") / F.lit(cell_rows))
    own = keys.select("id", "size", "text_crc32", "row", shard_of(splitters(keys, shards, tolerance=tolerance), tuple(map(F.col, ORDER))).alias("shard"), cell.alias("cell"))
    counts = own.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")
    start = counts.select("shard", "cell", before.alias("start"))
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("row")) - 1
    return own.withColumn("place", place).join(start, ["shard", "cell"]).select("id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).alias("slot"))


def write_shards(df: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE) -> str:
    """The rows of ``df`` themselves, exchanged once and written below ``path`` in one folder for each shard, each folder in
    as many files as it takes. The shard of a row follows from its id and text, as in :func:`sharded`, but for rows alike in
    both at a boundary, which go to the upper side together."""
    path = path or new_path(df.sparkSession, "shards")
    keys = keyed(df, id_col, text_col)
    bounds = [b[:2] for b in splitters(keys, shards, tolerance=tolerance)]
    (shard,) = free_names(df, "shard")
    df.withColumn(shard, shard_of(bounds, (text_hash(text_col), id_hash(id_col)))).hint("rebalance", F.col(shard)).write.partitionBy(shard).parquet(path)
    return path
