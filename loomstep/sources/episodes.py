"""Episode datasets on disk: step tables, episode and task tables, metadata, converters and statistics files.

Layout version 2 has a Parquet file for each episode and JSON lines as metadata; version 3 has many episodes in a file and
Parquet metadata with a file's number and, for each camera, its video's number and start. Everything goes through Spark's
readers or Hadoop's file system layer, so a dataset may be in any store.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstep.config import check_server
from loomstep.operators.windows import running_offset

CACHE_VERSION = 2
# File names and path templates of the public dataset layout.
INFO, MODALITY, EPISODE_LINES, TASK_LINES, EPISODE_TABLES, TASK_TABLE, DATA = "meta/info.json", "meta/modality.json", "meta/episodes.jsonl", "meta/tasks.jsonl", "meta/episodes", "meta/tasks.parquet", "data"
VIDEO_PATH = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"
EPISODES = T.StructType([T.StructField("episode_index", T.LongType()), T.StructField("tasks", T.ArrayType(T.StringType())), T.StructField("length", T.LongType())])
TASKS = T.StructType([T.StructField("task_index", T.LongType()), T.StructField("task", T.StringType())])
DEFAULT_COLUMNS = {"state": "observation.state", "action": "action"}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written beside its place and then renamed, so no reader sees a part of it."""
    fs, place = _fs(spark, path)
    tried = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(tried)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(place, False)
    if not fs.rename(tried, place):
        raise OSError(f"cannot rename to {path}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)


def episode_chunk(episode: Column, chunk_size: int) -> Column:
    return F.floor(episode / F.lit(chunk_size)).cast("long")


def path_of(template: str, values: Mapping[str, Column]) -> Column:
    """A column of paths from a template with {name} and {name:03d} fields."""
    form, used = "", []
    for text, name, width in re.findall(r"([^{]*)(?:\{(\w+)(?::(\d+)d)?\})?", template):
        form += text.replace("%", "%%")
        if name:
            form += f"%{width}d" if width else "%s"
            used.append(values[name].cast("long") if width else values[name])
    return F.format_string(form, *used)


@dataclass(frozen=True)
class Key:
    """A named [start, end) of a column."""

    modality: str
    name: str
    column: str
    start: int
    end: int
    absolute: bool = True
    rotation: str | None = None

    @property
    def dotted(self) -> str:
        return f"{self.modality}.{self.name}"


def modality_keys(document: Mapping) -> list[Key]:
    """State and action keys of a modality document, checked."""
    out = []
    for modality, default in DEFAULT_COLUMNS.items():
        for name, at in document.get(modality, {}).items():
            key = Key(modality, name, at.get("original_key") or default, int(at["start"]), int(at["end"]), at.get("absolute", True), at.get("rotation_type"))
            if not 0 <= key.start < key.end:
                raise ValueError(f"{key.dotted}: [{key.start}, {key.end}) is no range")
            out.append(key)
    return out


def unpivot_cameras(df: DataFrame, keys: Sequence[str], field: str) -> DataFrame:
    """(keys, camera, value) from columns named videos/<camera>/<field>."""
    names = [c for c in df.columns if re.fullmatch(rf"videos/.+/{field}", c)]
    cells = F.explode(F.array(*[F.struct(F.lit(c.split("/", 1)[1].rsplit("/", 1)[0]).alias("camera"), F.col(f"`{c}`").alias("value")) for c in names]))
    return df.select(*keys, cells.alias("c")).select(*keys, "c.camera", "c.value")


class EpisodeDataset:
    """Tables of one dataset root. Nothing is read before it is asked for; filters on episodes reach the Parquet scan."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.info = json.loads(read_text(spark, f"{self.root}/{INFO}"))
        self.version = 3 if str(self.info.get("codebase_version", "v2.0")).startswith("v3") else 2
        self.chunk_size = int(self.info.get("chunks_size", 1000))

    def steps(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.root}/{DATA}")

    def episode(self, index: int) -> DataFrame:
        """In version 2 only the folder of the episode's chunk is listed, if the data is laid out by chunk."""
        chunk = f"{self.root}/{DATA}/chunk={index // self.chunk_size:03d}"
        if self.version == 2 and exists(self.spark, chunk):
            return self.spark.read.option("basePath", f"{self.root}/{DATA}").parquet(chunk).where(F.col("episode_index") == index)
        return self.steps().where(F.col("episode_index") == index)

    def episodes(self) -> DataFrame:
        if self.version == 3:
            return self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.root}/{EPISODE_TABLES}")
        return self.spark.read.schema(EPISODES).json(f"{self.root}/{EPISODE_LINES}")

    def tasks(self) -> DataFrame:
        """(task_index, task), whatever the file calls the text."""
        if self.version == 3:
            raw = self.spark.read.parquet(f"{self.root}/{TASK_TABLE}")
            text = next(c for c in raw.columns if c != "task_index")
            return raw.select("task_index", F.col(f"`{text}`").alias("task"))
        return self.spark.read.schema(TASKS).json(f"{self.root}/{TASK_LINES}")

    def keys(self) -> list[Key]:
        return modality_keys(json.loads(read_text(self.spark, f"{self.root}/{MODALITY}")))

    def with_keys(self, wanted: Sequence[str]) -> DataFrame:
        """Steps with a column for each dotted key."""
        known = {k.dotted: k for k in self.keys()}
        if missing := [k for k in wanted if k not in known]:
            raise KeyError(f"no such keys: {missing}")
        cut = lambda k: F.slice(F.col(f"`{k.column}`"), k.start + 1, k.end - k.start).alias(k.dotted)
        return self.steps().select("episode_index", "frame_index", "timestamp", "task_index", *[cut(known[k]) for k in wanted])

    def with_tasks(self) -> DataFrame:
        """Steps with their task's text; episodes none of whose steps has one are left out, others stay whole."""
        both = self.steps().join(self.tasks(), "task_index", "left")
        return with_language(both, ["episode_index"], "task")

    def video_paths(self, camera: str) -> DataFrame:
        """(episode_index, path): by the episode's chunk, or by the numbers that version 3 keeps for each camera."""
        template, own = self.info["video_path"], self.episodes()
        chunk, file = episode_chunk(F.col("episode_index"), self.chunk_size), F.lit(0)
        if self.version == 3:
            chunk, file = F.col(f"`videos/{camera}/chunk_index`"), F.col(f"`videos/{camera}/file_index`")
        values = {"episode_chunk": chunk, "chunk_index": chunk, "file_index": file, "episode_index": F.col("episode_index"), "video_key": F.lit(camera)}
        return own.select("episode_index", path_of(template, values).alias("path"))

    def frame_times(self, camera: str) -> DataFrame:
        """Steps with their time in the camera's video."""
        if self.version != 3:
            return self.steps().withColumn("video_time", F.col("timestamp").cast("double"))
        start = self.episodes().select("episode_index", F.col(f"`videos/{camera}/from_timestamp`").alias("__from"))
        return self.steps().join(start, "episode_index").withColumn("video_time", F.col("timestamp") + F.coalesce("__from", F.lit(0.0))).drop("__from")


def with_language(steps: DataFrame, episode: Sequence[str], text: str) -> DataFrame:
    """Steps of the episodes that have an instruction at any step; the others are skipped as a whole."""
    told = steps.where(F.coalesce(F.trim(text), F.lit("")) != "").select(*episode).distinct()
    return steps.join(told, list(episode), "left_semi")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors see: below ``spark.checkpoint.dir``, or, under a local master without
    that setting, below a temporary folder of this machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        named = tempfile.mkdtemp(prefix="loomstep-")
    return f"{named.rstrip('/')}/loomstep/{uuid.uuid4().hex}"


def read_sorted(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files put together in the order of their paths: rows with their file's place as ``__file``."""
    out = None
    for k, path in enumerate(sorted(paths)):
        one = spark.read.parquet(path).withColumn("__file", F.lit(k))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def convert_logs(raw: DataFrame, episode: str, order: str, stride: int, fps: float) -> DataFrame:
    """Steps from raw states: the state ``stride`` rows before goes with the action now, at every ``stride``-th row."""
    w = Window.partitionBy(episode).orderBy(order)
    at = raw.withColumn("__i", F.row_number().over(w) - 1).withColumn("observation.state", F.lag("vector", stride).over(w))
    kept = at.where((F.col("__i") >= stride) & (F.col("__i") % stride == 0))
    frame = F.row_number().over(w) - 1
    return kept.select(
        F.col(episode).cast("long").alias("episode_index"), frame.cast("long").alias("frame_index"), (frame / F.lit(float(fps))).cast("float").alias("timestamp"),
        F.lit(0).cast("long").alias("task_index"), F.col("`observation.state`").cast("array<float>").alias("observation.state"), F.col("vector").cast("array<float>").alias("action"),
    )


def write_dataset(steps: DataFrame, tasks: DataFrame, modality: Mapping, root: str, fps: float, robot: str, chunk_size: int = 1000) -> EpisodeDataset:
    """A version 2 dataset. Steps are clustered by chunk of episodes and sorted within, with their running index."""
    spark, root = steps.sparkSession, root.rstrip("/")
    lengths = steps.groupBy("episode_index").agg(F.count("*").alias("length"), F.collect_set("task_index").alias("task_ids"))
    offsets = running_offset(lengths, "length", ["episode_index"], "__first").select("episode_index", "__first")
    rows = steps.join(offsets, "episode_index").withColumn("index", F.col("__first") + F.col("frame_index")).drop("__first")
    rows = rows.withColumn("chunk", F.format_string("%03d", episode_chunk(F.col("episode_index"), chunk_size)))
    rows.hint("rebalance", "chunk", "episode_index").sortWithinPartitions("chunk", "episode_index", "frame_index").write.mode("overwrite").partitionBy("chunk").parquet(f"{root}/{DATA}")
    texts = lengths.select("episode_index", "length", F.explode("task_ids").alias("task_index")).join(tasks, "task_index")
    episodes = texts.groupBy("episode_index", "length").agg(F.sort_array(F.collect_list("task")).alias("tasks")).orderBy("episode_index")
    for name, table in (("episodes", episodes.select("episode_index", "tasks", "length")), ("tasks", tasks.orderBy("task_index"))):
        table.write.mode("overwrite").json(f"{root}/meta/{name}.jsonl")
    total = lengths.agg(F.count("*"), F.sum("length")).first()
    info = {"codebase_version": "v2.0", "robot_type": robot, "total_episodes": total[0], "total_frames": total[1], "chunks_size": chunk_size, "fps": fps, "video_path": VIDEO_PATH}
    write_text(spark, f"{root}/{INFO}", json.dumps(info))
    write_text(spark, f"{root}/{MODALITY}", json.dumps(modality))
    return EpisodeDataset(spark, root)


def config_hash(config: Mapping) -> str:
    """Of the whole configuration, so that no change of it is served from an old cache."""
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()


def load_or_compute(spark: SparkSession, path: str, config: Mapping, compute) -> dict:
    """Statistics from the cache file if it is of this version and configuration, else computed and kept there."""
    if exists(spark, path):
        kept = json.loads(read_text(spark, path))
        if kept.get("version") == CACHE_VERSION and kept.get("config") == config_hash(config):
            return kept["statistics"]
    out = compute()
    write_text(spark, path, json.dumps({"version": CACHE_VERSION, "config": config_hash(config), "statistics": out}))
    return out


def mixture_document(by_tag: Mapping[str, Mapping], names: Sequence[str]) -> dict:
    """Statistics of every tag, with the names of the datasets that they are of."""
    return {**by_tag, "metadata": {"dataset_names": sorted(names)}}


def write_statistics(spark: SparkSession, path: str, document: Mapping) -> None:
    """Arrays, numpy's as well, become lists."""
    write_text(spark, path, json.dumps(document, default=lambda x: x.tolist()))


def load_merged(spark: SparkSession, path: str) -> dict:
    """Merged statistics from a JSON file; other formats, pickles above all, are refused."""
    if not path.lower().endswith(".json"):
        raise ValueError(f"statistics are read from JSON only: {path}")
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return json.loads(read_text(spark, path))


def apply_cached(document: Mapping, names: Sequence[str]) -> dict | None:
    """Statistics by tag from a cached document, or None where it is of other datasets than these."""
    kept = document.get("metadata")
    if kept is not None and set(kept.get("dataset_names", ())) != set(names):
        return None
    return {tag: x for tag, x in document.items() if tag != "metadata"}


def evaluation_summary(seed: int, server: Mapping, successes: Sequence[bool], **more) -> dict:
    """What one evaluation found, as a document."""
    check_server(seed, server)
    done = sum(map(bool, successes))
    return {"seed": seed, "ckpt_path": server["ckpt_path"], **more, "num_episodes": len(successes), "num_successes": done, "success_rate": done / len(successes) if successes else 0.0, "successes": [bool(x) for x in successes]}


def statistics_document(folded: DataFrame, key: str = "key", last: str = "gripper") -> dict:
    """Folded statistics (one row per key) as nested dictionaries; keys named after the gripper come last."""
    rows = sorted((r.asDict(recursive=True) for r in folded.collect()), key=lambda r: (last in str(r[key]), str(r[key])))
    return {r.pop(key): r for r in rows}


def verify_manifest(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """(file, status): ok, missing, or size where it differs from the wanted one."""
    found = there.select("file", F.col("size").alias("__size"), F.lit(True).alias("__there"))
    status = F.when(F.col("__there").isNull(), "missing").when(F.col("__size") != F.col("size"), "size").otherwise("ok")
    return wanted.join(found, "file", "left").select("file", "size", status.alias("status"))


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of all files below a folder, without their contents."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))


def archive_parts(files: DataFrame, name: str, marker: str = ".tar.part-") -> DataFrame:
    """Parts of archives in the order they are put together."""
    bits = F.split(F.col(name), re.escape(marker))
    return files.where(F.col(name).contains(marker)).groupBy(F.get(bits, F.lit(0)).alias("archive")).agg(F.sort_array(F.collect_list(F.get(bits, F.lit(1)))).alias("parts"))
