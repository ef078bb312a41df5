"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled good; the other side is unlabelled documents, of which an unknown share is good as
well. That share (the class prior) is estimated first: a classifier tells positives from unlabelled documents, and the least
ratio of the two upper tails of its scores bounds the share. A logistic model then minimises the non-negative unbiased risk:
the risk of unlabelled documents as negatives less the share's part of it that is due to positives, kept from going below 0.
Features describe how a text is written, not what it says: frequencies of neighbouring byte classes, repetition, lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelake.llm.common import is_held_out, release_memory, text_or_empty
from cyclelake.llm.samples import Adam, logistic, sampled_ids, sampled_texts, sigmoid

POSITIVES, UNLABELLED = 6_000, 12_000   # documents the model is fitted on, at most
ACCEPT = 0.3
BLOCK_CHARS = 200_000                   # long texts are described block by block
CLASSES = 16
# Bytes by class: letters, digits, blanks and non-ASCII by rule, the rest by what it is used for.
_MARKS = {".": 7, ",": 8, "!": 9, "?": 10, "'": 13, '"': 13, ":": 15, ";": 15} | dict.fromkeys("%$#&*@^~+=<>", 11) | dict.fromkeys(
    "|/\\_-", 12) | dict.fromkeys("()[]{}", 14)
_CLASS = np.zeros(256, np.int64)
_CLASS[[9, 32]], _CLASS[[10, 13]], _CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4, 5, 6
for _mark, _kind in _MARKS.items():
    _CLASS[ord(_mark)] = _kind
DENSE = 8


def features(text: str) -> np.ndarray:
    """Frequencies of neighbouring byte classes (square roots), then shares that tell repetition and lengths."""
    pairs = np.zeros(CLASSES * CLASSES)
    dense, total, words_seen = np.zeros(DENSE - 1), 0, 0
    for at in range(0, max(len(text), 1), BLOCK_CHARS):
        block = text[at:at + BLOCK_CHARS]
        kinds = _CLASS[np.frombuffer(b" " + block.encode() + b" ", np.uint8)]
        pairs += np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
        words, lines = block.split(), [x for x in block.split("\n") if x]
        n = len(words)
        if n:
            threes = max(n - 2, 1)
            dense += n * np.array([
                len(set(words)) / n, sum(map(eq, words, words[1:])) / n, min(1.0, len(set(zip(words, words[1:], words[2:]))) / threes),
                len(set(lines)) / max(len(lines), 1), min(len(block) / n, 40) / 10, sum(map(str.isupper, words)) / n,
                sum(map(str.isalpha, words)) / n])
            words_seen += n
        total += len(block)
    dense = dense / max(words_seen, 1)
    return np.concatenate([np.sqrt(pairs / pairs.sum()), dense, [np.log1p(words_seen) / 10]]).astype(np.float32)


@dataclass(frozen=True)
class QualityModel:
    """Scores are sigmoid(weights . (features - mean) / scale + bias). Without positives every score is 0.5."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        x = (np.stack([features(t) for t in texts]) - self.mean) / self.scale
        return sigmoid(x @ self.weights + self.bias)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence=0.1) -> float:
    """Share of positives among the unlabelled, from scores of rows that no model was fitted on: the least ratio of the
    upper tails, with a margin for small tails."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.99, 100)))
    above_p = np.array([(positive >= c).mean() for c in cuts])
    above_u = np.array([(unlabelled >= c).mean() for c in cuts])
    margin = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = np.argmin((above_u + margin) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.02, 0.98))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, epochs=60, batch=512, rate=0.02, ridge=1e-4, seed=0):
    """Weights and bias that minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) under the logistic loss."""
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(p.shape[1]), np.zeros(1)
    adam = Adam([weights, bias], rate)
    steps = max(1, (len(p) + len(u)) // batch)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        order_p, order_u = np.array_split(rng.permutation(len(p)), steps), np.array_split(rng.permutation(len(u)), steps)
        for rows_p, rows_u in zip(order_p, order_u):
            if len(rows_p) == 0 or len(rows_u) == 0:
                continue
            z_p, z_u = p[rows_p] @ weights + bias, u[rows_u] @ weights + bias
            negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
            g_u = sigmoid(z_u) / len(z_u)                       # of R_u(-)
            g_p = prior * sigmoid(z_p) / len(z_p)               # of prior * R_p(-)
            if negative < 0:    # the negative risk has been fitted too far: only undo that
                g_u, g_p = -g_u, g_p
            else:
                g_p = -prior * sigmoid(-z_p) / len(z_p) - g_p
            adam.step([p[rows_p].T @ g_p + u[rows_u].T @ g_u + ridge * weights, np.array([g_p.sum() + g_u.sum()])])
    return weights, float(bias[0])


def fit_quality(docs: DataFrame, labels: DataFrame, positives=POSITIVES, unlabelled=UNLABELLED, id_column="doc_id",
                text="text", label="quality") -> QualityModel:
    """A model from at most ``positives`` documents labelled 1 and ``unlabelled`` documents whose labels are not looked
    at, all outside the held-out fifth. Features are computed in tasks; the driver gets them and fits."""
    good = sampled_ids(labels.filter(F.col(label) == 1), positives, id_column).withColumn("_p", F.lit(1))
    web = sampled_ids(docs, unlabelled, id_column).withColumn("_p", F.lit(0))
    ids = good.unionByName(web).groupBy("_id").agg(F.max("_p").alias("_good"), F.min("_p").alias("_not_web"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"good": batch["_good"], "not_web": batch["_not_web"],
                                "x": [features(t).tobytes() for t in batch["_text"]], "id": batch["_place"]})

    # An order of rows that does not depend on partitions: whole numbers as they are, other ids by hash.
    whole = isinstance(ids.schema["_id"].dataType, T.IntegralType)
    place = F.col("_id").cast("bigint") if whole else F.xxhash64("_id")
    rows = sampled_texts(docs, ids, id_column, text).withColumn("_place", place).mapInPandas(
        describe, "good int, not_web int, x binary, id bigint").toPandas().sort_values(["id", "x"])
    width = CLASSES * CLASSES + DENSE
    blank = QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.5)
    if rows.empty:
        return blank
    x = np.stack([np.frombuffer(b, np.float32) for b in rows["x"]]).astype(np.float64)
    good_rows, web_rows = rows["good"].to_numpy() == 1, rows["not_web"].to_numpy() == 0
    if good_rows.sum() < 2 or web_rows.sum() < 2:
        return blank
    mean, scale = x[web_rows].mean(0), x[web_rows].std(0) + 0.01
    x = (x - mean) / scale
    p, u = x[good_rows], x[web_rows]
    # The prior comes from rows that the classifier for it has not seen.
    both, side = np.concatenate([p[::2], u[::2]]), np.concatenate([np.ones(len(p[::2])), np.zeros(len(u[::2]))])
    weight = np.where(side == 1, 0.5 / side.sum(), 0.5 / (1 - side).sum())
    beta = logistic(both, side, weight, ridge=0.01, steps=15)
    prior = class_prior(p[1::2] @ beta[:-1], u[1::2] @ beta[:-1])
    weights, bias = fit_nnpu(p, u, prior)
    return QualityModel(mean, scale, weights, bias, prior)


def quality_score(model: QualityModel, text="text") -> Column:
    """Score of a text from 0 to 1. Null texts are empty ones."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores(texts.tolist()), dtype="float64")
        release_memory()

    return score(text_or_empty(text))


def quality_scores(docs: DataFrame, labels: DataFrame, id_column="doc_id", text="text", **options) -> DataFrame:
    """id, held_out, score, predicted (1 if score >= 0.3): one row per input row. Null and empty texts are scored like
    others, repeated rows alike; rows without an id are not held out and teach nothing; ids may be numbers or texts. Texts are
    described whole: beyond 200,000 characters in blocks, whose shares (repetition, lengths) are averaged by their words. Without
    labels every score is 0.5. An empty table gives no rows. Other columns are not read."""
    model = fit_quality(docs, labels, id_column=id_column, text=text, **options)
    scored = docs.select(id_column, is_held_out(id_column).alias("held_out"), quality_score(model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, as they are: null texts count as empty ones, repeated rows stay or go
    together, ties with the threshold stay, an empty table stays empty."""
    model = fit_quality(docs, labels, **options)
    return docs.filter(quality_score(model, options.get("text", "text")) >= ACCEPT)
