"""Conversation records: messages, label masks, padding and packing of token sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IGNORE, START, STOP = -100, 77091, 151645  # fixed values: label of masked tokens; tokens that open and close an answer


def label_mask(ids: Column, start: int = START, stop: int = STOP) -> Column:
    """Labels equal to the ids inside answers and IGNORE elsewhere. An answer begins two places after a start token; it goes
    up to and with the place after its stop token. A start token within an answer, or without a later stop, opens none.

    Linear in the ids: they become a string of a letter each, in which an answer with its start is a match of one pattern; the
    pieces between and within matches give each place its kind, and no lambda looks at anything but its own elements."""
    marks = F.array_join(F.transform(ids, lambda x: F.when(x == start, "s").when(x == stop, "e").otherwise(".")), "")
    closed = F.regexp_extract(marks, "^.*e", 0)  # behind the last stop nothing can match
    answer = "s..*?e"
    between, within = F.split(closed, answer, -1), F.regexp_extract_all(closed, F.lit(f"({answer})"), F.lit(1))
    none, one, last = F.lit(0), F.lit(1), F.lit(2)  # outside, inside, the stop itself

    def kinds(gap: Column, found: Column) -> Column:
        inside = F.concat(F.array(none, none), F.array_repeat(one, F.length(found) - 3), F.array(last))
        return F.concat(F.array_repeat(none, F.length(gap)), F.when(F.length(found) > 0, inside).otherwise(F.array().cast("array<int>")))

    kind = F.flatten(F.zip_with(between, F.concat(within, F.array(F.lit(""))), kinds))
    kind = F.concat(kind, F.array_repeat(none, F.length(marks) - F.length(closed)))
    before = F.concat(F.array(none), kind)
    labelled = F.zip_with(kind, before, lambda k, b: (k > 0) | (b == 2))  # the last one has no place of its own: null
    return F.transform(F.arrays_zip(ids.alias("id"), F.slice(labelled, F.lit(1), F.size(ids)).alias("labelled")), lambda x: F.when(x["labelled"], x["id"]).otherwise(F.lit(IGNORE)))


def pad_to(ids: Column, size: Column, pad: int) -> Column:
    """Cut to ``size`` and filled up on the right."""
    return F.concat(F.slice(ids, F.lit(1), size), F.array_repeat(F.lit(pad), F.greatest(size - F.size(ids), F.lit(0))))


def collate(df: DataFrame, batch: Sequence[str], ids: str, pad: int, most: int) -> DataFrame:
    """Right-padded sequences of a batch to its longest, at most ``most``, and their attention."""
    w = Window.partitionBy(*batch)
    size = F.least(F.max(F.size(ids)).over(w), F.lit(most))
    out = df.withColumn("__size", size).withColumn(ids, pad_to(F.col(ids), F.col("__size"), pad)).drop("__size")
    return out.withColumn("attention", F.transform(ids, lambda x: (x != pad).cast("int")))


def pack_turns(df: DataFrame, group: Sequence[str], order: str, ids: str) -> DataFrame:
    """Sequences of a group in a row, with the bounds between them from 0 on."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(ids).alias("v"))))
    out = df.groupBy(*group).agg(rows.alias("__rows")).withColumn(ids, F.flatten(F.transform("__rows", lambda r: r["v"])))
    sizes = F.transform("__rows", lambda r: F.size(r["v"]))
    bounds = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return out.withColumn("bounds", bounds).drop("__rows")


def positions(bounds: Column) -> Column:
    """Places within each packed sequence."""
    return F.flatten(F.transform(F.slice(bounds, F.lit(2), F.size(bounds) - 1), lambda z, i: F.when(z > F.get(bounds, i), F.sequence(F.lit(0), z - F.get(bounds, i) - 1)).otherwise(F.array().cast("array<int>"))))


def text_length(words: Column, has_media: Column, media: int = 128) -> Column:
    return words + F.when(has_media, media).otherwise(0)


def signed_length(words: Column, has_media: Column) -> Column:
    return F.when(has_media, words).otherwise(-words)
