import json

import pytest
from pyspark.sql import functions as F

from loomstep.operators import evaluation as E
from loomstep.sources import episodes as S
from loomstep.sources import logs


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dataset"))
    raw = spark.range(100).selectExpr("id div 40 as ep", "id as i", "array(cast(id as double), id * 2.0, -id) as vector")
    steps = S.convert_logs(raw, "ep", "i", 3, 10.0)
    modality = {"state": {"arm": {"start": 0, "end": 2}}, "action": {"arm": {"start": 0, "end": 2}, "gripper": {"start": 2, "end": 3, "absolute": False}}}
    tasks = spark.createDataFrame([(0, "stack")], "task_index long, task string")
    return S.write_dataset(steps, tasks, modality, root, 10.0, "arm7", chunk_size=2)


def test_convert_aligns_state_and_action(dataset):
    rows = dataset.episode(1).orderBy("frame_index").collect()
    assert len(rows) == 13
    assert [r["observation.state"][0] for r in rows[:2]] == [40.0, 43.0] and [r["action"][0] for r in rows[:2]] == [43.0, 46.0]
    assert sorted(r["index"] for r in dataset.steps().collect()) == list(range(dataset.info["total_frames"]))
    assert "PushedFilters: [IsNotNull(episode_index), EqualTo(episode_index,1)]" in dataset.episode(1)._jdf.queryExecution().toString()


def test_keys_and_tasks(dataset):
    row = dataset.with_keys(["state.arm", "action.gripper"]).where("episode_index = 0 and frame_index = 0").first()
    assert row["state.arm"] == [0.0, 0.0] and row["action.gripper"] == [-3.0]
    with pytest.raises(KeyError):
        dataset.with_keys(["state.leg"])
    assert dataset.with_tasks().select("task").distinct().collect()[0][0] == "stack"
    assert {r["episode_index"]: r["path"] for r in dataset.video_paths("wrist").collect()}[2] == "videos/chunk-001/wrist/episode_000002.mp4"


def test_version_3(spark, tmp_path):
    root = str(tmp_path)
    spark.range(6).selectExpr("id div 3 as episode_index", "id % 3 as frame_index", "cast(id % 3 / 10 as float) as timestamp", "0L as task_index").write.parquet(f"{root}/data/chunk-000")
    meta = spark.createDataFrame([(0, 3, 0, 4, 0.0), (1, 3, 1, 5, 2.5)], "`episode_index` long, `length` long, `videos/cam/chunk_index` long, `videos/cam/file_index` long, `videos/cam/from_timestamp` double")
    meta.write.parquet(f"{root}/meta/episodes/chunk-000")
    spark.createDataFrame([(0, "pour")], "task_index long, `__index_level_0__` string").write.parquet(f"{root}/meta/tasks.parquet")
    S.write_text(spark, f"{root}/meta/info.json", json.dumps({"codebase_version": "v3.0", "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"}))
    d = S.EpisodeDataset(spark, root)
    assert {r["path"] for r in d.video_paths("cam").collect()} == {"videos/cam/chunk-000/file-004.mp4", "videos/cam/chunk-001/file-005.mp4"}
    assert d.frame_times("cam").where("episode_index = 1 and frame_index = 1").first()["video_time"] == pytest.approx(2.6)
    assert d.with_tasks().first()["task"] == "pour"


def test_statistics_cache(spark, tmp_path):
    path, calls = str(tmp_path / "stats.json"), []
    compute = lambda: calls.append(1) or {"a": 1}
    assert [S.load_or_compute(spark, path, c, compute) for c in ({"h": 1}, {"h": 1}, {"h": 2})] == [{"a": 1}] * 3
    assert len(calls) == 2


def test_modality_ranges_are_checked():
    with pytest.raises(ValueError):
        S.modality_keys({"state": {"x": {"start": 3, "end": 3}}})


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("steps_5000_model_infer_carrot-v0.log.run1 -> Average success: 0.25\nnoise\nsteps_6000_model_infer_spoon-v0.log.run2 -> Average success: 0.75\n")
    lines = logs.read_lines(spark, str(tmp_path))
    assert [(r["step"], r["task"], r["run"], r["score"]) for r in logs.parse_scores(lines).orderBy("step").collect()] == [(5000, "carrot", 1, 0.25), (6000, "spoon", 2, 0.75)]
    assert E.last_line(lines, "success").select(logs.last_field(F.col("value"))).first()[0] == "0.75"
    (tmp_path / "j").mkdir()
    (tmp_path / "j/x.json").write_text('{"grasp": {"total_count": 4, "success_count": 3}}')
    (tmp_path / "j/y.json").write_text('{"grasp": {"total_count": 6, "success_count": 2}, "pour": {"total_count": 1, "success_count": 1}}')
    got = {r["category"]: r["rate"] for r in E.merge_counts(logs.eval_counts(spark, str(tmp_path / "j")), "category").collect()}
    assert got == {"grasp": 0.5, "pour": 1.0, None: 6 / 11}


def test_manifest(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"1234")
    there = S.files_of(spark, str(tmp_path)).select(F.element_at(F.split("file", "/"), -1).alias("file"), "size")
    wanted = spark.createDataFrame([("a.bin", 4), ("b.bin", 1)], "file string, size long")
    assert {r["file"]: r["status"] for r in S.verify_manifest(wanted, there).collect()} == {"a.bin": "ok", "b.bin": "missing"}
