"""Datasets on disk: written to the shared folder and read back, with their metadata, statistics and logs."""

import json

from pyspark.sql import functions as F

from loomstep.operators import evaluation as E
from loomstep.operators import lookups as L
from loomstep.operators import stats as S
from loomstep.operators import windows as W
from loomstep.plans.registry import query, table
from loomstep.sources import episodes as D
from loomstep.sources import logs
from loomstep.sources.stand_ins import STEPS_SQL, steps

MODALITY_DOCUMENT = {
    "state": {"arm": {"start": 0, "end": 1}, "gripper": {"start": 1, "end": 2, "absolute": False}},
    "action": {"arm": {"start": 0, "end": 1}, "gripper": {"start": 1, "end": 2, "original_key": "action"}},
}
STRIDE = 3


def _raw(spark, sf_dir):
    """Raw robot states: each event of a user, as a vector of its value and its place."""
    return steps(spark, sf_dir).select("episode", "t", F.array("value", F.col("t").cast("double")).alias("vector"))


def _dataset(spark, sf_dir):
    tasks = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("task_index"), F.col("n_name").alias("task"))
    return D.write_dataset(D.convert_logs(_raw(spark, sf_dir), "episode", "t", STRIDE, 10.0), tasks, MODALITY_DOCUMENT, f"{D.shared_folder(spark)}-dataset", 10.0, "arm7", chunk_size=50)


@query("S06_modality_metadata", "SELECT * FROM (VALUES ('state.arm', 'observation.state', 0, 1, true), ('state.gripper', 'observation.state', 1, 2, false), ('action.arm', 'action', 0, 1, true), ('action.gripper', 'action', 1, 2, true)) AS k(key, source, lo, hi, absolute)")
def modality_metadata(spark, sf_dir):
    """The modality document, checked, as one row for each key."""
    path = f"{D.shared_folder(spark)}-modality.json"
    D.write_text(spark, path, json.dumps(MODALITY_DOCUMENT))
    keys = D.modality_keys(json.loads(D.read_text(spark, path)))
    return spark.createDataFrame([(k.dotted, k.column, k.start, k.end, k.absolute) for k in keys], "key string, source string, lo int, hi int, absolute boolean")


_KEPT = f"(SELECT episode, t, value, lag(value, {STRIDE}) OVER (PARTITION BY episode ORDER BY t) AS before FROM {STEPS_SQL})"
_ROWS = f"(SELECT *, row_number() OVER (PARTITION BY episode ORDER BY t) - 1 AS frame FROM {_KEPT} WHERE t >= {STRIDE} AND t % {STRIDE} = 0)"


@query("S07_info_paths", f"SELECT episode, printf('videos/chunk-%03d/wrist/episode_%06d.mp4', (episode // 50)::INT, episode::INT) AS path, (SELECT count(*) FROM {_ROWS}) AS total_frames FROM (SELECT DISTINCT episode FROM {_ROWS})")
def info_paths(spark, sf_dir):
    """Templates, chunk size and totals of the info document."""
    d = _dataset(spark, sf_dir)
    return d.video_paths("wrist").select(F.col("episode_index").alias("episode"), "path", F.lit(d.info["total_frames"]).cast("long").alias("total_frames"))


@query("S26_converted_dataset", f"WITH r AS {_ROWS} SELECT episode, frame, row_number() OVER (ORDER BY episode, frame) - 1 AS index, round(value, 3) AS action, round(before, 3) AS state, (SELECT n_name FROM nation WHERE n_nationkey = 0) AS task FROM r")
def converted_dataset(spark, sf_dir):
    """Raw states to steps and metadata, written and read again: state and action keys, running index and task."""
    d = _dataset(spark, sf_dir)
    own = d.with_keys(["state.arm", "action.arm"]).select("episode_index", "frame_index", F.get(F.col("`state.arm`"), F.lit(0)).alias("s"), F.get(F.col("`action.arm`"), F.lit(0)).alias("a"))
    own = own.join(d.with_tasks().select("episode_index", "frame_index", "index", "task"), ["episode_index", "frame_index"])
    return own.select(F.col("episode_index").alias("episode"), F.col("frame_index").alias("frame"), "index", F.round(F.col("a").cast("double"), 3).alias("action"), F.round(F.col("s").cast("double"), 3).alias("state"), "task")


@query("S19_raw_states", f"SELECT episode, t, round(value, 5) AS value FROM {STEPS_SQL}")
def raw_states(spark, sf_dir):
    """JSON lines with blank ones among them."""
    path = f"{D.shared_folder(spark)}-states"
    rows = steps(spark, sf_dir).select("episode", F.explode(F.array(F.to_json(F.struct("episode", "t", "value")), F.when(F.col("t") % 5 == 0, "").otherwise(F.lit(None)))).alias("line")).where("line is not null")
    rows.select("line").write.text(path)
    return logs.raw_states(spark, path, "episode long, t long, value double").select("episode", "t", F.round("value", 5).alias("value"))


_COUNTS = "(SELECT n_regionkey AS suite, n_name AS category, count(*) AS total_count, count(*) FILTER (WHERE c_acctbal > 0) AS success_count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"
_RATES = f"SELECT category, sum(total_count)::BIGINT AS total, sum(success_count)::BIGINT AS successes, round(sum(success_count) / sum(total_count), 6) AS rate FROM {_COUNTS}"


def _suites(spark, sf_dir):
    """A JSON document of categories and their counts for each suite; returns the folder."""
    both = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counts = both.groupBy(F.col("n_regionkey").alias("suite"), F.col("n_name").alias("category")).agg(F.count("*").alias("total_count"), F.sum((F.col("c_acctbal") > 0).cast("long")).alias("success_count"))
    folder, of = f"{D.shared_folder(spark)}-suites", {}
    for r in counts.collect():  # a catalogue: one row for each suite and category
        of.setdefault(r["suite"], {})[r["category"]] = {"total_count": r["total_count"], "success_count": r["success_count"]}
    for suite, document in of.items():
        D.write_text(spark, f"{folder}/{suite}/result.json", json.dumps(document))
    return folder, sorted(of)


def _rated(counts):
    return E.merge_counts(counts, "category").withColumn("rate", F.round("rate", 6))


@query("S20_listed_results", _RATES + " WHERE suite IN (0, 1) GROUP BY ROLLUP (category)")
def listed_results(spark, sf_dir):
    folder, suites = _suites(spark, sf_dir)
    return _rated(logs.eval_counts(spark, [f"{folder}/{s}/result.json" for s in suites if s in (0, 1)]))


@query("S21_globbed_results", _RATES + " GROUP BY ROLLUP (category)")
def globbed_results(spark, sf_dir):
    folder, _ = _suites(spark, sf_dir)
    return _rated(logs.eval_counts(spark, f"{folder}/*/*.json"))


_STATS = ("mean", "std", "min", "max", "q01", "q99")
_VALUES = "avg(value) AS mean, stddev_pop(value) AS std, min(value) AS min, max(value) AS max, quantile_cont(value, 0.01) AS q01, quantile_cont(value, 0.99) AS q99"
_ROUNDED = ", ".join(f"round({c}, 5) AS {c}" for c in _STATS)
_BY_TYPE = f"SELECT event_type AS tag, {_ROUNDED} FROM (SELECT event_type, {_VALUES} FROM events GROUP BY 1)"


def _by_tag(spark, sf_dir):
    """Statistics of each tag as a document: bounded by the catalogue of tags."""
    rows = S.describe(table(spark, sf_dir, "events").select(F.col("event_type").alias("tag"), "value"), ["tag"]).collect()
    return {r["tag"]: {c: r[c] for c in _STATS} for r in rows}


def _rows_of(spark, document):
    rows = [(tag, *[float(x[c]) for c in _STATS]) for tag, x in document.items()]
    out = spark.createDataFrame(rows, "tag string, " + ", ".join(f"`{c}` double" for c in _STATS))
    return out.select("tag", *[F.round(c, 5).alias(c) for c in _STATS])


@query("S28_cached_statistics", _BY_TYPE)
def cached_statistics(spark, sf_dir):
    """Computed once and kept; read from the cache then; another configuration, or a file of another version, is not served."""
    path, config = f"{D.shared_folder(spark)}-stats.json", {"mode": "abs", "horizon": 1}
    D.write_text(spark, path, json.dumps({"version": 1, "statistics": {}}))
    D.load_or_compute(spark, path, config, lambda: _by_tag(spark, sf_dir))

    def never():
        raise AssertionError("the cache should have been read")

    return _rows_of(spark, D.load_or_compute(spark, path, config, never))


@query("S31_mixture_statistics", _BY_TYPE)
def mixture_statistics(spark, sf_dir):
    """Written with the names of their datasets, loaded, and taken over as the names are the same."""
    path, names = f"{D.shared_folder(spark)}-dataset_statistics.json", ["b", "a"]
    D.write_statistics(spark, path, D.mixture_document(_by_tag(spark, sf_dir), names))
    return _rows_of(spark, D.apply_cached(D.load_merged(spark, path), sorted(names)))


@query("S33_vector_statistics_file", "SELECT pos::BIGINT AS pos, round(avg(v), 5) + 0.0 AS mean FROM (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1")
def vector_statistics_file(spark, sf_dir):
    """Arrays go into the document as lists and come back as rows."""
    import numpy as np

    path = f"{D.shared_folder(spark)}-stats.json"
    long = S.explode_vector(table(spark, sf_dir, "embeddings"), "embedding").groupBy("pos").agg(F.avg("value").alias("mean"))
    rows = sorted((r["pos"], r["mean"]) for r in long.collect())  # one row for each dimension
    D.write_statistics(spark, path, {"action": {"mean": np.array([m for _, m in rows])}})
    kept = D.load_merged(spark, path)["action"]["mean"]
    return spark.createDataFrame(list(enumerate(kept)), "pos long, mean double").select("pos", (F.round("mean", 5) + 0.0).alias("mean"))


@query("S34_csv_of_scores", "SELECT user_id % 7 AS step, round(avg(value) FILTER (WHERE event_type = 'click'), 5) AS click, round(avg(value) FILTER (WHERE event_type = 'view'), 5) AS \"view\" FROM events GROUP BY 1")
def csv_of_scores(spark, sf_dir):
    """A pivot written as one CSV with a header, and read again."""
    path = f"{D.shared_folder(spark)}-scores"
    e = table(spark, sf_dir, "events").withColumn("step", F.col("user_id") % 7)
    E.pivot_mean(e, "step", "event_type", "value", ["click", "view"]).orderBy("step").coalesce(1).write.option("header", True).csv(path)  # as many rows as steps
    back = spark.read.option("header", True).schema("step long, click double, `view` double, average double").csv(path)
    return back.select("step", F.round("click", 5).alias("click"), F.round("view", 5).alias("view"))


@query("S35_evaluation_summary", "SELECT 7::BIGINT AS seed, count(*) AS num_episodes, count(*) FILTER (WHERE s_acctbal > 0) AS num_successes, round(avg((s_acctbal > 0)::INT), 6) AS success_rate FROM supplier")
def evaluation_summary(spark, sf_dir):
    path = f"{D.shared_folder(spark)}-summary.json"
    flags = [r[0] for r in table(spark, sf_dir, "supplier").select(F.col("s_acctbal") > 0).collect()]  # the episodes of one evaluation
    D.write_text(spark, path, json.dumps(D.evaluation_summary(7, {"ckpt_path": "model", "seed": 7}, flags)))
    kept = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "seed long, num_episodes long, num_successes long, success_rate double").alias("s"))
    return kept.select("s.seed", "s.num_episodes", "s.num_successes", F.round("s.success_rate", 6).alias("success_rate"))


def _mode_sql():
    one = lambda k: f"coalesce(lead(value, {k}) OVER w, last_value(value) OVER x)"
    moved = ", ".join(f"{one(k) if k else 'value'} AS c{k}" for k in range(3))
    base = f"(SELECT coalesce(lag(value, 1) OVER w, value) AS s, {moved} FROM {STEPS_SQL} WINDOW w AS (PARTITION BY episode ORDER BY t), x AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
    parts = [f"SELECT 'abs' AS mode, 0 AS pos, value FROM {STEPS_SQL}"]
    parts += [f"SELECT 'rel', {k}, c{k} - s FROM {base}" for k in range(3)]
    parts += [f"SELECT 'delta', {k}, c{k} - {'s' if k == 0 else f'c{k - 1}'} FROM {base}" for k in range(3)]
    return f"SELECT mode, pos::BIGINT AS pos, {_ROUNDED} FROM (SELECT mode, pos, {_VALUES} FROM ({' UNION ALL '.join(parts)}) GROUP BY 1, 2)"


@query("A04_mode_statistics", _mode_sql())
def mode_statistics(spark, sf_dir):
    """Each mode's own cells: values, differences within a chunk, or distances to the state before it."""
    out = None
    for mode in ("abs", "rel", "delta"):
        one = S.mode_statistics(steps(spark, sf_dir), ["episode"], ["t"], "value", range(3), mode, state_offset=-1).withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out.select("mode", F.col("pos").cast("long").alias("pos"), *[F.round(c, 5).alias(c) for c in _STATS])


@query("A05_load_or_compute", "SELECT 'first' AS asked, true AS computed UNION ALL SELECT 'same', false UNION ALL SELECT 'other horizon', true")
def load_or_compute(spark, sf_dir):
    """Which requests had to compute: the first, and that of another configuration."""
    path, done, out = f"{D.shared_folder(spark)}-stats.json", [], []
    for name, horizon in (("first", 1), ("same", 1), ("other horizon", 2)):
        before = len(done)
        D.load_or_compute(spark, path, {"horizon": horizon}, lambda: done.append(1) or _by_tag(spark, sf_dir))
        out.append((name, len(done) > before))
    return spark.createDataFrame(out, "asked string, computed boolean")


@query("A11_apply_cached", "SELECT 'same names' AS datasets, true AS applied, (SELECT count(DISTINCT event_type) FROM events) AS tags UNION ALL SELECT 'other names', false, 0")
def apply_cached(spark, sf_dir):
    """Cached statistics are taken over only where they are of the same datasets."""
    document, out = D.mixture_document(_by_tag(spark, sf_dir), ["a", "b"]), []
    for name, current in (("same names", ["b", "a"]), ("other names", ["a", "c"])):
        got = D.apply_cached(document, current)
        out.append((name, got is not None, len(got or {})))
    return spark.createDataFrame(out, "datasets string, applied boolean, tags long")


_NEXT = "coalesce(lead(value, {k}) OVER w, last_value(value) OVER x)"


@query(
    "P16_raw_steps",
    f"SELECT episode, t, coalesce(lag(event_id, 2) OVER w, first_value(event_id) OVER x) AS frame, round(value, 5) AS state, round({_NEXT.format(k=1)} - value, 5) + 0.0 AS action1, round({_NEXT.format(k=2)} - value, 5) + 0.0 AS action2, event_type AS lang FROM {STEPS_SQL} WINDOW w AS (PARTITION BY episode ORDER BY t), x AS (PARTITION BY episode ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
)
def raw_steps(spark, sf_dir):
    """Video, state, action and language of every base step in one window; the action relative to the state."""
    keys = [("video.front", "event_id", [-2], "first_last"), ("state.arm", "value", [0], "first_last"), ("action.arm", "value", [1, 2], "first_last"), ("annotation.task", "event_type", [0], "first_last")]
    out = W.raw_steps(steps(spark, sf_dir), ["episode"], ["t"], keys, {"action.arm": ("rel", "state.arm")})
    at = lambda name, k: F.get(F.col(f"`{name}`"), F.lit(k))
    return out.select("episode", "t", at("video.front", 0).alias("frame"), F.round(at("state.arm", 0), 5).alias("state"), *[(F.round(at("action.arm", k), 5) + 0.0).alias(f"action{k + 1}") for k in (0, 1)], at("annotation.task", 0).alias("lang"))


@query("J03_sample_time_pairs", "SELECT * FROM (VALUES ('action.arm', 'state.arm'), ('action.hand', 'state.fingers'), ('action.base', NULL), ('other', NULL)) AS p(key, state_key)")
def sample_time_pairs(spark, sf_dir):
    """The state of each action when samples are made; a pair without one is skipped, not an error."""
    found = [(k, L.state_key_of(k, {"action.hand": "state.fingers"}, {"state.arm", "state.fingers"})) for k in ("action.arm", "action.hand", "action.base", "other")]
    return spark.createDataFrame(found, "key string, state_key string")


@query("K01_sorted_paths", "SELECT p_partkey, (p_partkey % 3)::INT AS file FROM part")
def sorted_paths(spark, sf_dir):
    """Files are put together in the order of their paths, however they are listed."""
    folder, parts = D.shared_folder(spark), table(spark, sf_dir, "part")
    paths = [f"{folder}-part-{k}" for k in range(3)]
    for k, path in enumerate(paths):
        parts.where(F.col("p_partkey") % 3 == k).select("p_partkey").write.parquet(path)
    return D.read_sorted(spark, [paths[2], paths[0], paths[1]]).select("p_partkey", F.col("__file").alias("file"))
