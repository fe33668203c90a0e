"""What the training-data operators share: the shared folder, written tables, fixed patterns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as a Java and a DuckDB (RE2) character class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: what ``spark.checkpoint.dir`` names.

    Only a local master may run without that setting; it then gets a temporary folder of this machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if sc.master.startswith("local-cluster"):
            raise ValueError("local-cluster executors need spark.checkpoint.dir as well")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loomstep-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/loomstep/{uuid.uuid4().hex}-{name}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there, and lost executors take nothing with them."""
    return _write(df, new_path(df.sparkSession, name))


def _write(df: DataFrame, path: str) -> DataFrame:
    """Nothing reads the exchanges behind the table again, so Spark is asked to delete their files once it is there."""
    spark = df.sparkSession
    was = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The written tables of one operator's run, each deleted as soon as no later step and no result reads it."""

    def __init__(self) -> None:
        self.held: list[tuple[DataFrame, str]] = []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(df.sparkSession, name)
        self.held.append((_write(df, path), path))
        return self.held[-1][0]

    def drop(self, *frames: DataFrame) -> None:
        self._forget(lambda held: any(held is f for f in frames))

    def keep(self, *frames: DataFrame) -> None:
        """Delete all but these."""
        self._forget(lambda held: not any(held is f for f in frames))

    def _forget(self, goes: Callable[[DataFrame], bool]) -> None:
        for frame, path in self.held:
            if goes(frame):
                drop_path(frame.sparkSession, path)
        self.held = [(frame, path) for frame, path in self.held if not goes(frame)]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system layer, whatever store it is in."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Python gets Arrow batches of at most BATCH_BYTES and a row. Spark's own bounds are 10,000 rows and 64 MiB, held by the JVM
    and by Python for each running task. Plans read the setting when they run, so it stays; a smaller one is left."""
    if not 0 < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() <= BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def without_space(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+", "")


def utf8_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text falls into the held-out part; a null id is never held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
