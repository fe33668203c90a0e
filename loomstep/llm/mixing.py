"""Mixing sources to target weights, in DataFrame operations only.

Sizes add up per source; weights give each source a share of all words; no source is asked for more than ``most`` times its
size, and what that leaves over is shared again by weight (water-filling, in closed form over the sources sorted by size for
their weight). A source's rate is target / size; each document is taken floor(rate) times and once more if a seeded hash of
its id and text falls below the rate's fraction. Rows alike in id, text and source are numbered, and the number of all but the first
is hashed as well, so that copies without an id are drawn one by one. The same rows give the same mix in any run and on any
number of executors.

Defined results: a null text has size 0; a null source is a source of its own, last; a source without words has rate 0;
of repeated rows any may have any of their numbers; a null id is hashed like any other value; extra columns do not matter; an
empty table gives an empty result. The table of sources is as long as there are sources; it is joined by Spark's own choice of
join. Numbers are given cell by cell, a cell being a stretch of the input, so no task holds all rows of a repeated row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_names, written

WEIGHTS, MOST, SEED = (5, 2, 1), 3, 7
CELL_ROWS = 1 << 16


def unit(id_col: str, digest: Column, occurrence: Column | None = None, seed: int = SEED) -> Column:
    """A number in [0, 1) from 52 bits of the md5 of seed, id, the text's digest and the number of a repeated row."""
    number = [] if occurrence is None else [F.when(occurrence > 0, occurrence.cast("string"))]
    named = F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"), digest, *number)
    return F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def digest_of(text_col: str) -> Column:
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def size_of(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def numbered(rows: DataFrame, key: str, row: str, name: str) -> DataFrame:
    """``rows`` with each one's number, from 0, among those of its key. Only rows of keys that repeat are exchanged twice."""
    n, cell, start = free_names(rows, "__count", "__cell", "__start")
    often = rows.groupBy(key).agg(F.count("*").alias(n)).where(F.col(n) > 1)
    marked = rows.join(often, key, "left")
    once = marked.where(F.col(n).isNull()).drop(n).withColumn(name, F.lit(0).cast("long"))
    many = marked.where(F.col(n).isNotNull()).drop(n).withColumn(cell, F.floor(F.col(row) / CELL_ROWS))
    counts = many.groupBy(key, cell).agg(F.count("*").alias(start))
    before = counts.select(key, cell, (F.sum(start).over(Window.partitionBy(key).orderBy(cell)) - F.col(start)).alias(start))
    place = F.row_number().over(Window.partitionBy(key, cell).orderBy(row)) - 1
    many = many.withColumn(name, place).join(before, [key, cell])
    return once.unionByName(many.withColumn(name, F.col(name) + F.col(start)).drop(cell, start))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size). Windows here run over sources, not documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (place + 1).cast("int")))
    # Sources reach their limit in order of limit / weight. With the first k at it, the rest share what is left by weight;
    # the level of that split is right for the first k whose next source stays at or below its limit.
    per = per.withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("tight", F.col("limit") / F.col("weight"))
    order = Window.orderBy("tight", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight_left)
    per = per.withColumn("level", F.min(F.when(F.col("level") <= F.col("tight"), F.struct("tight", F.col("source").isNull(), "source", "level"))).over(every)["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit")))
    return per.select("source", "source_size", target.alias("target"), F.coalesce(F.try_divide(target, F.col("source_size").cast("double")), F.lit(0.0)).alias("rate"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies): one row for each row of ``df``."""
    own = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"), digest_of(text_col).alias("digest"), F.monotonically_increasing_id().alias("row"))
    own = written(own.withColumn("key", F.xxhash64("id", "source", "digest")), "sizes")
    goal = written(targets(own, weights, most), "targets").withColumnRenamed("source", "__s")
    own = numbered(own, "key", "row", "number").withColumn("unit", unit("id", F.col("digest"), F.col("number")))
    copies = F.floor("rate") + (F.col("unit") < F.col("rate") - F.floor("rate")).cast("long")
    return own.join(goal, own["source"].eqNullSafe(goal["__s"])).select("id", "source", "size", "source_size", "target", "rate", copies.alias("copies"))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, in ``df``'s columns. The rates join to the rows, whose
    text is moved by no exchange as long as the table of sources is small enough for Spark to broadcast; only repeated rows
    are exchanged with their texts, to be numbered."""
    name, rate, copies, one, key, row, number = free_names(df, "__source", "__rate", "__copies", "__copy", "__key", "__row", "__number")
    own = df.select(F.col(source_col).alias("source"), size_of(text_col).alias("size"), F.xxhash64(id_col, source_col, digest_of(text_col)).alias("key"))
    own = written(own, "sizes")
    goal = written(targets(own, weights, most), "targets").select(F.col("source").alias(name), F.col("rate").alias(rate))
    often = written(own.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias(key)), "repeated")
    rows = df.withColumn(number, F.lit(0).cast("long"))
    if not often.isEmpty():
        keyed = df.withColumn(key, F.xxhash64(id_col, source_col, digest_of(text_col))).withColumn(row, F.monotonically_increasing_id())
        again = numbered(keyed.join(often, key, "left_semi"), key, row, number)
        rows = keyed.join(often, key, "left_anti").withColumn(number, F.lit(0).cast("long")).unionByName(again).drop(key, row)
    whole = F.floor(rate)
    taken = whole + (unit(id_col, digest_of(text_col), F.col(number)) < F.col(rate) - whole).cast("long")
    joined = rows.join(goal, rows[source_col].eqNullSafe(goal[name])).withColumn(copies, taken.cast("int"))
    return joined.withColumn(one, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(*df.columns)
