"""Text logs as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCORE = r"steps_(\d+)_.*infer_(.+)-v0\.log\.run(\d+).*Average success: ([0-9.]+)"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): lines numbered within their file, in order. Each file is one row of the input until then."""
    whole = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\n")).alias("line", "value"))


def parse_scores(lines: DataFrame, pattern: str = SCORE, text: str = "value") -> DataFrame:
    """Step, task, run and score of the lines that match."""
    part = lambda k: F.regexp_extract(text, pattern, k)
    return lines.where(F.col(text).rlike(pattern)).select("*", part(1).cast("long").alias("step"), part(2).alias("task"), part(3).cast("long").alias("run"), part(4).cast("double").alias("score"))


def last_field(text: Column) -> Column:
    return F.element_at(F.split(F.trim(text), r"\s+"), -1)


def eval_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, category, total_count, success_count) from JSON files of categories to counts."""
    raw = spark.read.option("wholetext", True).text(paths).select(F.input_file_name().alias("file"), "value")
    parsed = F.from_json("value", "map<string,struct<total_count:bigint,success_count:bigint>>")
    return raw.select("file", F.explode(parsed).alias("category", "c")).select("file", "category", "c.total_count", "c.success_count")


def raw_states(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank lines are none."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "line") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
