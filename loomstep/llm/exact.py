"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by successive blocks of their normalised bytes. A round counts each (group, next block); a document
alone in its new group is done, as is one whose text has ended; only the others go on, with the rest of their bytes, to the
next, wider block. Texts that differ early leave after a few bytes, so what later rounds move is the shared prefixes and the
copies. Groups are counted with partial sums before any exchange, and the count joins back as one row for each group, so a
group of copies with a third of all rows is never gathered: Spark may split its rows over tasks. Equality is that of the
bytes; no digest decides anything. Each round is a written table, so lost executors cost one round at most.

Defined results: a null text counts as empty, and empty texts are copies of each other; of equal texts the row with the most
code points in its original text stays, then the smallest id (null last); of rows that tie in both, exactly one is kept; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_names, text_of, without_space, written

FIRST, WIDER, WIDEST = 64, 8, 1 << 30  # bytes of the first block; factor of the next one; as many as a text may have


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = FIRST, wider: int = WIDER, scratch: Scratch | None = None) -> DataFrame:
    """(id, row, code_points, sha256, keep_id, group_size, kept): one row for each row of ``df``.

    ``row`` numbers the rows of this result; sha256 is that of the normalised text, as information. The result reads the
    rounds' tables; whoever gives a ``scratch`` may delete them when it has been read.
    """
    scratch = scratch or Scratch()
    text = text_of(text_col)
    norm = without_space(text).cast("binary")
    docs = df.select(F.col(id_col).alias("id"), F.length(text).cast("long").alias("code_points"), F.sha2(norm, 256).alias("sha256"), F.lit(0).cast("long").alias("g"), norm.alias("rest"))
    narrow = ["id", "row", "code_points", "sha256"]
    done, width, start = [], first, True
    while True:
        cut = docs.withColumn("block", F.substring("rest", 1, width))
        if start:
            cut = cut.withColumn("row", F.monotonically_increasing_id())
        groups = cut.groupBy("g", "block").agg(F.count("*").alias("n")).where("n > 1")
        groups = scratch.written(groups.withColumn("new_g", F.monotonically_increasing_id()), "radix-groups")
        ended = F.octet_length("block") < width
        # Merged at every size: Spark can split a large group's rows, and a small table does not change what is moved.
        split = cut.join(groups.hint("merge"), ["g", "block"], "left").select(
            *narrow,
            F.col("new_g").alias("g"),
            F.when(F.col("n").isNull(), 0).when(ended, 1).otherwise(2).alias("state"),
            F.when(F.col("n").isNotNull() & ~ended, F.substring(F.col("rest"), width + 1, 2147483647)).alias("rest"),
        )
        split = scratch.written(split, "radix-round")
        scratch.drop(groups)
        done.append(split.where("state < 2").select(*narrow, "state", F.struct(F.lit(len(done)).alias("round"), "g").alias("g")))
        docs = split.where("state = 2").select(*narrow, "g", "rest")
        if docs.isEmpty():
            break
        width, start = min(width * wider, WIDEST), False
    alone = done[0].where("state = 0")
    copies = done[0].where("state = 1")
    for more in done[1:]:
        alone, copies = alone.unionByName(more.where("state = 0")), copies.unionByName(more.where("state = 1"))
    # Code points first, then the id with null last, then the row: the least such tuple stays.
    order = F.struct((-F.col("code_points")).alias("c"), F.col("id").isNull().alias("u"), F.col("id").alias("id"), F.col("row").alias("row"))
    best = scratch.written(copies.groupBy("g").agg(F.count("*").alias("group_size"), F.min(order).alias("best")), "radix-best")
    of_copies = copies.join(best, "g").select(*narrow, F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"))
    return alone.select(*narrow, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")).unionByName(of_copies)


def keep_first_of_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that stay. Rows of a repeated id are told apart by code points and normalised text; those alike in
    all three are copies of each other, and one of them stays at most."""
    rounds = Scratch()
    found = written(exact_groups(df, id_col, text_col, scratch=rounds, **how).select("id", "code_points", "sha256", "kept"), "radix-kept")
    rounds.keep()
    key, points, digest, n = free_names(df, "__id", "__code_points", "__sha256", "__n")
    if found.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        gone = found.where("not kept").select(F.col("id").alias(key))
        return df.join(gone.hint("merge"), df[id_col].eqNullSafe(gone[key]), "left_anti")
    text = text_of(text_col)
    own = df.withColumns({points: F.length(text).cast("long"), digest: F.sha2(without_space(text).cast("binary"), 256)})
    stay = found.groupBy("id", "code_points", "sha256").agg(F.count("*").alias(n), F.max("kept").alias("kept")).where("kept")
    stay = stay.select(F.col("id").alias(key), F.col("code_points").alias(points + "_"), F.col("sha256").alias(digest + "_"), n)
    both = own.join(stay, own[id_col].eqNullSafe(stay[key]) & (own[points] == stay[points + "_"]) & (own[digest] == stay[digest + "_"]))
    one = both.where(F.col(n) > 1).dropDuplicates([key, points, digest])
    return both.where(F.col(n) == 1).unionByName(one).select(*df.columns)
