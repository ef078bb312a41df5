"""Bounded samples of labelled documents for fitting classifiers, and the numpy helpers the classifiers share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelake.llm.common import is_held_out, text_or_empty


def sampled_ids(df: DataFrame, rows: int, id_column="doc_id") -> DataFrame:
    """At most ``rows`` ids that are not held out: those with the smallest hashes."""
    usable = df.filter(F.col(id_column).isNotNull() & ~is_held_out(id_column)).select(F.col(id_column).alias("_id"))
    return usable.distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows)


def sampled_texts(docs: DataFrame, ids: DataFrame, id_column="doc_id", text="text", **columns: Column) -> DataFrame:
    """(_id, _text and the columns of ``ids``) of the sampled documents, one row per id. ``ids`` is bounded by the sample
    sizes, so it is broadcast."""
    rows = docs.select(F.col(id_column).alias("_id"), text_or_empty(text).alias("_text"))
    return rows.join(F.broadcast(ids), "_id").dropDuplicates(["_id"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Adam:
    """Gradient steps for a list of arrays, in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for a, g, m, v in zip(self.arrays, gradients, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= scale * m / (np.sqrt(v) + 1e-8)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge=1e-3, steps=40) -> np.ndarray:
    """Newton's method for a weighted logistic regression; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.append(np.ones(x.shape[1] - 1), 0)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - y)) / weight.sum() + penalty * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x / weight.sum() + np.diag(penalty + 1e-9)
        move = np.linalg.solve(hessian, gradient)
        beta -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-8:
            break
    return beta
