"""Bounded samples of labelled documents, and scores as probabilities."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, marks: DataFrame, label: str, learn: Column, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """(text, y): at most ``per_class`` documents of either label, those of the least hash of their id. Ids are chosen from
    the labels alone, so no text moves but the sample's. Labels that are null, or that repeat and disagree, do not count; of
    an id with several texts the least is learned."""
    one = marks.where(learn & F.col(id_col).isNotNull() & F.col(label).isin(0, 1)).groupBy(id_col).agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z")
    pick = None
    for y in (0, 1):
        few = one.where(F.col("y") == y).select(id_col, "y").orderBy(F.xxhash64(id_col), id_col).limit(per_class)
        pick = few if pick is None else pick.unionByName(few)
    chosen = pick.toPandas()
    if not len(chosen):
        return pd.DataFrame({"text": [], "y": []})
    few = docs.sparkSession.createDataFrame(chosen[[id_col]])  # at most 2 x per_class ids
    rows = docs.select(id_col, text_col).join(F.broadcast(few), id_col, "left_semi").groupBy(id_col).agg(F.min(F.coalesce(text_col, F.lit(""))).alias("text")).toPandas()
    rows = rows.merge(chosen, on=id_col).sort_values(id_col)
    return pd.DataFrame({"text": rows["text"].to_numpy(object), "y": rows["y"].to_numpy(int)})


def platt(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a margin + b))), by Newton steps with the usual smoothed targets."""
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g = np.array([((p - t) * margins).sum() + 1e-6 * a, (p - t).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def probability(margins: np.ndarray, a: float, b: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
