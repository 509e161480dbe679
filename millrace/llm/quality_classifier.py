"""A quality classifier learned from preferences: Bradley-Terry on pairs of documents.

A document of label 1 is preferred to one of label 0. The strength of a document is linear in its
statistics, and the chance that one is preferred is the logistic function of the difference of the
strengths, so the model is fitted by logistic loss on differences of features. The strength at a
quantile of the labelled rows becomes the threshold, and strengths are mapped to 0 to 1 around it. The
quantile is chosen on all labelled rows but the held-out fold: by strengths from models of other rows those
that the model learned from, the others as counts per strength and label.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of, labelled_sample, remainder
from millrace.llm.statistics import COUNTS, ratios, text_counts
from millrace.session import materialize

SAMPLE_ROWS = 20_000
PAIRS = 60_000
STEPS = 300
RATE = 0.5
RIDGE = 1e-3
HELD_OUT = 5
# Parts of the learned rows, each measured by a model of the others.
FOLDS = 4
# Strengths of the other rows are counted in steps of this share of their spread.
STEP = 0.005
# Quantiles of the strength that are tried as threshold, and what a wrongly rejected clean row costs.
QUANTILES = 400
CLEAN_COST = 2.0
# The score at the threshold.
CUT = 0.3


@dataclass
class Strength:
    """Centre and width per statistic, weights of the derived features, threshold and width of scores."""

    centre: np.ndarray
    width: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    scale: float = 1.0

    def features(self, x: np.ndarray) -> np.ndarray:
        """Standardized statistics, and how far each lies outside the usual on either side."""
        z = (x - self.centre) / self.width
        above, below = np.clip(z - 2, 0, 8), np.clip(-z - 2, 0, 8)
        return np.hstack([np.clip(z, -3, 3), above, below])

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scaled(self, strength: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the strength; ``CUT`` at the threshold."""
        z = (strength - self.cut) / self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_strength(x: np.ndarray, label: np.ndarray, seed: int = 5) -> Strength:
    """The weights from random preference pairs; without rows of both labels all strengths are 0."""
    usual = x[label == 1] if (label == 1).any() else x
    centre = np.median(usual, axis=0) if len(usual) else np.zeros(x.shape[1])
    spread = usual.std(axis=0) if len(usual) else np.ones(x.shape[1])
    overall = x.std(axis=0) if len(x) else spread
    model = Strength(centre, np.maximum(np.maximum(spread, 0.05 * overall), 1e-6), np.zeros(3 * x.shape[1]))
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(better) or not len(worse):
        return model
    random = np.random.default_rng(seed)
    features = model.features(x)
    pairs = features[random.choice(better, PAIRS)] - features[random.choice(worse, PAIRS)]
    weights, speed = model.weights, np.zeros(features.shape[1])
    for _ in range(STEPS):  # gradient descent with momentum on the whole set of pairs
        wrong = 1 / (1 + np.exp(np.clip(pairs @ weights, -50, 50)))
        gradient = -(wrong @ pairs) / PAIRS + RIDGE * weights
        speed = 0.9 * speed - RATE * gradient / 10
        weights = weights + speed
    model.weights = weights
    return model


def choose_quantile(model: Strength, strength: np.ndarray, label: np.ndarray, rows: np.ndarray) -> None:
    """Sets the threshold: the quantile of the strengths with the least cost of wrong decisions.

    Each strength and label stands for so many ``rows``.
    """
    if not (label == 1).any() or not (label == 0).any():
        return
    order = np.argsort(strength, kind="stable")
    strength, label, rows = strength[order], label[order], rows[order].astype(np.float64)
    reached = np.cumsum(rows) / rows.sum()
    places = np.searchsorted(reached, np.arange(1, QUANTILES) / QUANTILES)
    cuts = np.unique(strength[np.minimum(places, len(order) - 1)])
    cost = [
        CLEAN_COST * rows[(label == 1) & (strength < c)].sum() + rows[(label == 0) & (strength >= c)].sum()
        for c in cuts
    ]
    best = int(np.argmin(cost))
    # half way to the next lower strength, so that rows at the quantile itself lie clearly above
    lower = strength[strength < cuts[best]]
    model.cut = float((cuts[best] + lower.max()) / 2) if len(lower) else float(cuts[best])
    mean = np.average(strength, weights=rows)
    model.scale = max(1e-6, float(np.sqrt(np.average((strength - mean) ** 2, weights=rows))) / 2)


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 5
) -> tuple[Strength, tuple[np.ndarray, np.ndarray], DataFrame]:
    """A model from at most ``rows`` labelled documents, none of them of the held-out fold.

    With it come the strengths of these by models of other rows, their labels, and ``(doc_id, label)``
    of all labelled rows outside the held-out fold that it did not learn from.
    """
    known = labels.filter(remainder(parts=HELD_OUT) != 0)
    sample = labelled_sample(documents_of(docs), known, "quality", rows, seed)
    counted = sample.select("doc_id", "label", text_counts(F.col("text")).alias("c"))
    data = counted.select("doc_id", "label", "c.*").toPandas().sort_values("doc_id")
    x = ratios({name: data[name].to_numpy() for name in COUNTS})
    label = data["label"].to_numpy()
    model = fit_strength(x, label, seed)
    fold = np.array([zlib.crc32(f"{seed}:{d}".encode()) % FOLDS for d in data["doc_id"]], np.int64)
    strength = model.strength(x)
    for f in np.unique(fold):
        inside = fold != f
        if len(np.unique(label[inside])) == 2:
            strength[~inside] = fit_strength(x[inside], label[inside], seed).strength(x[~inside])
    marked = (
        known.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    ids = [(d,) for d in data["doc_id"].tolist()]
    learned = docs.sparkSession.createDataFrame(ids, sample.select("doc_id").schema)
    return model, (strength, label), marked.join(F.broadcast(learned), "doc_id", "left_anti")


def settle(
    model: Strength, learned: tuple[np.ndarray, np.ndarray], others: DataFrame, strengths: DataFrame
) -> None:
    """Sets the threshold from all labelled rows: those learned from, and the ``others``.

    ``strengths`` holds ``doc_id`` and ``strength`` of all documents. Only counts per step of the
    strength and label reach the driver.
    """
    strength, label = learned
    rows = np.ones(len(label))
    if not others.isEmpty():
        width = max(1e-9, float(np.std(strength)) * STEP) if len(strength) else 1.0
        step = F.floor(F.col("strength") / width).alias("step")
        counts = (
            strengths.join(others, "doc_id").groupBy(step, "label").agg(F.count(F.lit(1)).alias("n")).toPandas()
        ).sort_values(["step", "label"])
        strength = np.concatenate([strength, (counts["step"].to_numpy(np.float64) + 0.5) * width])
        label = np.concatenate([label, counts["label"].to_numpy(np.int64)])
        rows = np.concatenate([rows, counts["n"].to_numpy(np.float64)])
    choose_quantile(model, strength, label, rows)


def _strength_udf(model: Strength):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.strength(ratios({name: batch[name].to_numpy() for name in COUNTS})))

    return F.pandas_udf(run, "double")


def _score_udf(model: Strength):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for strength in batches:
            yield pd.Series(model.scaled(strength.to_numpy()))

    return F.pandas_udf(run, "double")


def classify(docs: DataFrame, labels: DataFrame, seed: int = 5) -> DataFrame:
    """Per document ``doc_id, held_out, score, predicted``.

    The score looks at the text alone. Null text counts as empty, and empty texts have a score too.
    A null id is never held out. Repeated rows are scored one by one. Without labels of both kinds
    every score is the same, at the cut.
    """
    model, learned, others = learn(docs, labels, seed=seed)
    counted = documents_of(docs).select("doc_id", text_counts(F.col("text")).alias("counts"))
    inputs = F.struct(*[F.col(f"counts.{name}") for name in COUNTS])
    # a number per document
    strengths = materialize(counted.select("doc_id", _strength_udf(model)(inputs).alias("strength")), "strength")
    settle(model, learned, others, strengths)
    scored = strengths.select("doc_id", _score_udf(model)("strength").alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(parts=HELD_OUT) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
