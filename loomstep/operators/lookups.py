"""Lookups between steps, tasks, cameras and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.operators.windows import place_in_order


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, right_id: str, name: str = "nearest") -> DataFrame:
    """For each left row the right row of its key that is nearest in time, the earlier one on ties. Both sides go into one
    sorted sequence per key; the neighbours before and after are carried by window functions, so no pairs are made."""
    keys = list(keys)
    columns = left.columns
    a = left.withColumns({"__t": F.col(left_time), "__r": F.lit(None).cast(right.schema[right_id].dataType), "__side": F.lit(1)})
    b = right.select(*keys, F.col(right_time).alias("__t"), F.col(right_id).alias("__r"), F.lit(0).alias("__side"))
    both = a.unionByName(b, allowMissingColumns=True)
    point = F.when(F.col("__side") == 0, F.struct(F.col("__t").alias("t"), F.col("__r").alias("r")))
    before = F.last(point, ignorenulls=True).over(Window.partitionBy(*keys).orderBy("__t", "__side", F.desc("__r")))
    after = F.last(point, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc("__t"), "__side", F.desc("__r")))
    found = both.withColumn("__b", before).withColumn("__a", after).where("__side = 1")
    gap_b, gap_a = F.abs(F.col("__t") - F.col("__b.t")), F.abs(F.col("__a.t") - F.col("__t"))
    pick = F.when(F.col("__a").isNull() | (gap_b <= gap_a), F.col("__b.r")).otherwise(F.col("__a.r"))
    return found.withColumn(name, pick).select(*columns, name)


def pair_action_state(actions: DataFrame, states: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Action keys with the state key of the same name, or the one that a mapping names; dimensions side by side."""
    named = actions.withColumn("state_key", F.regexp_replace("key", "^action\\.", "state."))
    if mapping is not None:
        named = named.join(F.broadcast(mapping.withColumnRenamed("state_key", "__s")), "key", "left").withColumn("state_key", F.coalesce("__s", "state_key")).drop("__s")
    own = states.select(F.col("key").alias("state_key"), F.col("dim").alias("state_dim"))
    return named.join(own, "state_key", "left").withColumn("usable", F.coalesce(F.col("dim") == F.col("state_dim"), F.lit(False)))


def state_key_of(action_key: str, mapping: dict[str, str], states: set[str]) -> str | None:
    """The state key that goes with an action key when samples are made: the mapped one, else the one of the same name if there
    is such a state; None where the pair is to be skipped."""
    if action_key in mapping:
        return mapping[action_key]
    kind, _, name = action_key.partition(".")
    return f"state.{name}" if kind == "action" and f"state.{name}" in states else None


def zip_cycling(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Batches of two streams side by side for as many steps as the longer has; the shorter begins again. Streams are in order
    of a whole-number key without repeats, which is numbered by stretches."""
    a, b = place_in_order(left, left_key, "__i"), place_in_order(right, right_key, "__j")
    n, m = left.count(), right.count()
    steps = left.sparkSession.range(max(n, m) if n and m else 0).withColumnRenamed("id", "step")
    out = steps.join(a, steps["step"] % max(n, 1) == a["__i"]).join(b, steps["step"] % max(m, 1) == b["__j"])
    return out.drop("__i", "__j")


def same_set(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: whether both have the same keys, by what either has and the other lacks."""
    a, b = left.select(F.col(left_key).alias("key")), right.select(F.col(right_key).alias("key"))
    return a.subtract(b).unionByName(b.subtract(a)).agg((F.count("*") == 0).alias("equal"))


def split_combined(stats: DataFrame, keys: DataFrame) -> DataFrame:
    """A combined vector cut for keys in order by their explicit dimensions: [start, end) by running sum."""
    w = Window.orderBy("place")
    ranged = keys.withColumn("end", F.sum("dim").over(w)).withColumn("start", F.col("end") - F.col("dim"))
    hit = (stats["pos"] >= ranged["start"]) & (stats["pos"] < ranged["end"])
    return stats.join(F.broadcast(ranged), hit).withColumn("pos", F.col("pos") - F.col("start")).drop("start", "end")


def dispatch(kind: Column, ways: Mapping[str, Column], otherwise: Column | None = None) -> Column:
    """The column that goes with each row's kind. A kind that none is given for ends the query, unless ``otherwise`` is."""
    out = None
    for name, way in ways.items():
        out = F.when(kind == name, way) if out is None else out.when(kind == name, way)
    return out.otherwise(otherwise if otherwise is not None else F.raise_error(F.concat(F.lit("unknown kind: "), F.coalesce(kind, F.lit("null")))))


def without(df: DataFrame, column: str, listed: Sequence[str]) -> DataFrame:
    """Rows whose value is not listed; a null is not."""
    return df.where(F.coalesce(~F.col(column).isin(*listed), F.lit(True))) if listed else df


def select_families(df: DataFrame, name: str, wanted: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of the wanted families, named by name or alias, whatever the letter case. A name that no row has ends the query.
    ``df`` is a catalogue: its names are looked through once more for that."""
    of = {a.lower(): n.lower() for a, n in (aliases or {}).items()}
    asked = {of.get(w.lower(), w.lower()) for w in wanted}
    found = {r[0] for r in df.select(F.lower(name)).where(F.lower(name).isin(*asked)).distinct().collect()}  # as many as asked at most
    if unknown := sorted(asked - found):
        raise ValueError(f"unknown families: {unknown}")
    return df.where(F.lower(name).isin(*asked))


def pack_sample(action: Sequence[Column], state: Sequence[Column] = (), lang: Column | None = None, tag: str | None = None) -> Column:
    """A sample as one struct: keys put together in order and cast, with its instruction and its robot's tag."""
    fields = [F.concat(*action).cast("array<float>").alias("action")]
    fields += [F.concat(*state).cast("array<float>").alias("state")] if state else []
    fields += [lang.alias("lang")] if lang is not None else []
    return F.struct(*fields, *([F.lit(tag).alias("robot_tag")] if tag else []))


def missing_keys(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return wanted.join(known, key, "left_anti")


def resolve(key: Column) -> tuple[Column, Column]:
    """(modality, name) of a dotted key."""
    parts = F.split(key, r"\.", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
