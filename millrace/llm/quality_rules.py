"""Quality rules by an isolation forest over rule statistics.

Trees of random splits are grown on clean labelled rows; a text whose statistics part from theirs ends
after few splits. Each split is drawn a little beyond the values that the node holds, so that what
lies outside of all clean rows is cut off early too, also along statistics that clean rows never vary
in. The path length below which a text counts as anomalous is read off the labelled rows: all of
them, as counts per path length and label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of, labelled_sample
from millrace.llm.statistics import COUNTS, ratios, text_counts
from millrace.session import materialize

# Fixed by the contract: what fails regardless of the forest.
LEAST_WORDS = 20
MOST_REPEATED = 30

SAMPLE_ROWS = 20_000
TREES = 128
TREE_ROWS = 256
DEPTH = 18
BEYOND = 0.2
# Path lengths are counted in steps of this size when the threshold is chosen.
STEP = 0.02
# A clean text that is rejected costs as much as this many junk texts that stay.
CLEAN_COST = 4.0


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows: what a cut branch still lacks."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe)


@dataclass
class Forest:
    """Trees as flat arrays, a row per tree: split feature (-1 at a leaf), cut, left child, path."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row of ``x`` over the trees."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, path in zip(self.feature, self.cut, self.left, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, left[node] + right, node)
            total += path[node]
        return total / max(1, len(self.feature))


def grow(x: np.ndarray, span: np.ndarray, seed: int = 3, trees: int = TREES, rows: int = TREE_ROWS) -> Forest:
    """A forest over random subsets of ``x``; ``span`` is the width of each column over all rows.

    Without rows every tree is one leaf, and all texts have the same path length.
    """
    random = np.random.default_rng(seed)
    grown = []
    usable = np.flatnonzero(span > 0)
    for _ in range(trees):
        held = [x[random.choice(len(x), min(rows, len(x)), replace=False)]] if len(x) else [x]
        depth, feature, cut, left, path = [0], [], [], [], []
        at = 0
        while at < len(held):  # breadth first; children are appended side by side
            part, d = held[at], depth[at]
            if len(part) < 2 or d >= DEPTH or not len(usable):
                f, c, child = -1, 0.0, -1
            else:
                f = int(usable[random.integers(len(usable))])
                pad = BEYOND * span[f]
                c = float(random.uniform(part[:, f].min() - pad, part[:, f].max() + pad))
                child = len(held)
                above = part[:, f] >= c
                held += [part[~above], part[above]]
                depth += [d + 1, d + 1]
            feature.append(f)
            cut.append(c)
            left.append(child)
            path.append(d + float(_mean_path(len(part))) if f < 0 else 0.0)
            at += 1
        grown.append((feature, cut, left, path))
    most = max(len(g[0]) for g in grown)
    pad = lambda values, fill: np.array([v + [fill] * (most - len(v)) for v in values])
    columns = list(zip(*grown, strict=True))
    return Forest(pad(columns[0], -1), pad(columns[1], 0.0), pad(columns[2], -1), pad(columns[3], 0.0))


def base_failed(counts: str = "counts") -> Column:
    """Fewer than 20 words, or more than 30 % of them in repeated windows."""
    return (F.col(f"{counts}.n_words") < LEAST_WORDS) | (
        100 * F.col(f"{counts}.n_repeat_words") > MOST_REPEATED * F.col(f"{counts}.n_words")
    )


def _path_udf(forest: Forest):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(forest.paths(ratios({name: batch[name].to_numpy() for name in COUNTS})))

    return F.pandas_udf(run, "double")


def fit_forest(texts: DataFrame, labels: DataFrame, seed: int = 3, rows: int = SAMPLE_ROWS) -> Forest:
    """A forest from at most ``rows`` labelled documents: grown on the clean, spans from all."""
    sample = labelled_sample(texts, labels, "quality", rows, seed)
    found = sample.select("doc_id", "label", text_counts(F.col("text")).alias("c")).select(
        "doc_id", "label", "c.*"
    )
    data = found.toPandas().sort_values("doc_id")
    x = ratios({name: data[name].to_numpy() for name in COUNTS})
    span = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(x.shape[1])
    return grow(x[(data["label"] == 1).to_numpy()], span, seed)


def threshold(paths: DataFrame, labels: DataFrame, clean_cost: float = CLEAN_COST) -> float:
    """The path length that parts clean from junk at the least cost over all labelled rows of ``paths``.

    ``paths`` holds ``doc_id`` and ``path``. Rows are counted per step of path length and label;
    only these counts reach the driver. Without labels of both kinds nothing is anomalous.
    """
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("label"))
    steps = (
        paths.join(known, "doc_id")
        .groupBy(F.floor(F.col("path") / STEP).alias("step"))
        .agg(F.sum(F.col("label")).alias("clean"), F.sum(1 - F.col("label")).alias("junk"))
        .orderBy("step")
        .collect()
    )
    clean = np.array([0] + [r["clean"] for r in steps], np.float64)
    junk = np.array([0] + [r["junk"] for r in steps], np.float64)
    if not clean.sum() or not junk.sum():
        return float("-inf")
    # reject the first i steps: clean rows lost against junk rows that stay
    cost = clean_cost * np.cumsum(clean) + junk.sum() - np.cumsum(junk)
    best = int(cost.argmin())
    if best == 0:
        return float("-inf")
    last = steps[best - 1]["step"] + 1
    following = steps[best]["step"] if best < len(steps) else last
    return (last + following) / 2 * STEP  # in the middle of the gap above the last rejected step


def judge(docs: DataFrame, labels: DataFrame, seed: int = 3) -> DataFrame:
    """Per document ``doc_id``, the counts, ``base_failed``, ``path``, ``threshold`` and ``kept``.

    Null and empty texts have no words and fail the base. Repeated rows are judged one by one. A
    document without a label is judged like any other; null labels take no part. Without labelled
    rows only the base rules decide.
    """
    texts = documents_of(docs)
    forest = fit_forest(texts, labels, seed)
    counted = texts.select("doc_id", text_counts(F.col("text")).alias("counts"))
    inputs = F.struct(*[F.col(f"counts.{name}") for name in COUNTS])
    scored = counted.withColumn("path", _path_udf(forest)(inputs))
    stored = materialize(scored, "paths")  # a few numbers per document
    # the base decides alone where it rejects
    least = threshold(stored.filter(~base_failed()).select("doc_id", "path"), labels)
    return stored.select(
        "doc_id",
        *[F.col(f"counts.{name}").alias(name) for name in COUNTS],
        base_failed().alias("base_failed"),
        "path",
        F.lit(least).alias("threshold"),
        (~base_failed() & (F.col("path") >= least)).alias("kept"),
    )
