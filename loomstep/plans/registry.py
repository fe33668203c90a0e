"""All registered queries with their SQL counterparts, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
GROUPS = ("sources", "windows", "statistics", "transforms", "mixtures", "conversations", "evaluation", "lookups", "state", "datasets", "features", "images")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of (spark, sf_dir) under a name, with SQL that gives the same rows where there is some."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["W00_normalized_chunks"](spark, sf_dir)


for group in GROUPS:
    import_module(f"loomstep.plans.{group}")
