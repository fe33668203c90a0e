"""Session defaults for local runs and tests; a cluster brings its own."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g", **more: str) -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": driver_memory,
    } | {k.replace("__", "."): v for k, v in more.items()}
    return SparkSession.builder.master(f"local[{cores}]").appName("loomstep").config(map=conf).getOrCreate()
