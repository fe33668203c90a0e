"""The tables at hand seen as episodes: ``events`` by user, ``lineitem`` by order, ``embeddings`` as vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ACTION = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
#: The same in SQL.
STEPS_SQL = """(SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t, event_id, event_type, value,
  count(*) OVER (PARTITION BY user_id) AS len FROM events)"""
CELLS_SQL = """(SELECT l_returnflag AS tag, 0 AS pos, l_quantity AS value FROM lineitem UNION ALL SELECT l_returnflag, 1, l_extendedprice FROM lineitem
  UNION ALL SELECT l_returnflag, 2, l_discount FROM lineitem UNION ALL SELECT l_returnflag, 3, l_tax FROM lineitem)"""


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(episode, t, event_id, event_type, value, len), one row for each event."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.select(
        F.col("user_id").alias("episode"),
        (F.row_number().over(w) - 1).cast("long").alias("t"),
        "event_id",
        "event_type",
        "value",
        F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("len"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tag, pos, value): the four measures of lineitem as dimensions of a vector."""
    from loomstep.operators.stats import long_columns

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_returnflag", "tag")
    return long_columns(rows, ACTION, ["tag"])
