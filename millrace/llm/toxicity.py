"""Toxicity by a classifier chain.

The categories are predicted one after the other: each is a linear model over the words of a text and
over the probabilities of the categories before it. Those probabilities are out-of-fold predictions
when the later models are trained, so a later model learns how far an earlier one can be trusted on
texts it has not seen. The last category is the verdict. Its cut is chosen on all labelled rows: by their
out-of-fold probabilities those that the chain learned from, the others as counts per probability and label.

Labels that only say toxic or not are split first: terms that mark toxic texts are gathered into
groups that occur in the same texts (of one language, say), and each group is a category.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of, labelled_sample
from millrace.session import materialize

SAMPLE_ROWS = 12_000
KINDS = 4
FOLDS = 4
SPACE = 1 << 20
# Beginnings of words that are features beside the whole words: inflected forms share them.
STEMS = (4, 5, 6)
# Features that the models look at: so many that part the labels best, and beyond them those that do so
# beyond doubt (a chance of one in a million, as there are so many), up to a bound of the models' size.
CHOSEN = 256
SURE = 4.9
MOST_CHOSEN = 1024
STEPS = 200
RATE = 1.0
RIDGE = 1e-4
# What a clean text called toxic costs against a toxic one missed, when the cut is chosen.
CLEAN_COST = 5.0
# Rows that were not learned from are counted per step of the logarithm of the odds for this.
STEP = 0.01
# Bytes of words whose features a task remembers, about; a task that has ended remembers nothing.
REMEMBERED_BYTES = 40 << 20
MARKS = ".,!?;:\"'()[]{}|*#%&$<>-_"


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % SPACE


class Terms(dict):
    """Feature numbers of words as bytes, remembered by word; bounded in bytes."""

    held = 0

    def __missing__(self, word: str) -> bytes:
        if self.held >= REMEMBERED_BYTES:
            self.clear()
            self.held = 0
        core = word.strip(MARKS)
        names = [f"w {core}"] + [f"s {core[:n]}" for n in STEMS if len(core) >= n] if core else []
        found = self[word] = np.array([_hash(n) for n in names], np.uint32).tobytes()
        self.held += 200 + 2 * len(word) + len(found)
        return found


def features_of(text: str, terms: Terms | None = None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text, whatever its case."""
    words = set(text.lower().split())
    terms = Terms() if terms is None else terms
    return np.unique(np.frombuffer(b"".join(map(terms.__getitem__, words)), np.uint32))


def _packed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    terms = Terms()
    for batch in texts:
        yield pd.Series([features_of(text or "", terms).tobytes() for text in batch])


@dataclass
class Link:
    """One model of the chain: weights of the chosen features, of earlier probabilities, and a bias."""

    terms: np.ndarray
    earlier: np.ndarray
    bias: float

    def predict(self, x: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        z = x @ self.terms + earlier @ self.earlier + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """The chosen features and the links in order; the last link gives the verdict, from ``cut`` on."""

    chosen: np.ndarray
    links: list[Link] = field(default_factory=list)
    cut: float = 0.5

    def rows(self, features: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(features), len(self.chosen)), np.float32)
        for i, found in enumerate(features):
            place = np.searchsorted(self.chosen, found)
            place[place == len(self.chosen)] = 0
            hit = place[self.chosen[place] == found] if len(self.chosen) else place[:0]
            x[i, hit] = 1
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of each category, a column per link."""
        out = np.zeros((len(x), 0))
        for link in self.links:
            out = np.column_stack([out, link.predict(x, out)])
        return out


def fit_link(x: np.ndarray, earlier: np.ndarray, label: np.ndarray) -> Link:
    """Logistic regression by gradient descent with momentum; both labels weigh the same."""
    n, positive = len(label), int(label.sum())
    terms, before, bias = np.zeros(x.shape[1], np.float32), np.zeros(earlier.shape[1]), 0.0
    if positive == 0 or positive == n:
        return Link(terms, before, 4.0 if n and positive else -4.0)
    weight = np.where(label == 1, 0.5 / positive, 0.5 / (n - positive))
    speeds = [np.zeros_like(terms), np.zeros_like(before), 0.0]
    for _ in range(STEPS):
        z = x @ terms + earlier @ before + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * weight
        gradients = [
            x.T @ error.astype(np.float32) + RIDGE * terms,
            earlier.T @ error + RIDGE * before,
            error.sum(),
        ]
        speeds = [0.9 * s - RATE * g for s, g in zip(speeds, gradients, strict=True)]
        terms, before, bias = terms + speeds[0], before + speeds[1], bias + speeds[2]
    return Link(terms.astype(np.float32), before, float(bias))


def fit_chain(features: list[np.ndarray], chosen: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """Links for the columns of ``labels`` in order; ``fold`` numbers the fold of each row."""
    chain, verdict = fit_links(features, chosen, labels, fold)
    chain.cut = least_cost(verdict, labels[:, -1])
    return chain


def fit_links(
    features: list[np.ndarray], chosen: np.ndarray, labels: np.ndarray, fold: np.ndarray
) -> tuple[Chain, np.ndarray]:
    """As ``fit_chain``, without a cut, and each row's out-of-fold probability of the last category."""
    chain = Chain(chosen)
    x = chain.rows(features)
    outside = np.zeros((len(features), 0))  # out-of-fold probabilities of the links so far
    for k in range(labels.shape[1]):
        predicted = np.zeros(len(features))
        for f in np.unique(fold):
            inside = fold != f
            part = fit_link(x[inside], outside[inside], labels[inside, k])
            predicted[~inside] = part.predict(x[~inside], outside[~inside])
        chain.links.append(fit_link(x, outside, labels[:, k]))
        outside = np.column_stack([outside, predicted])
    return chain, outside[:, -1]


def least_cost(probability: np.ndarray, label: np.ndarray, rows: np.ndarray | None = None) -> float:
    """The cut with the least cost of wrong verdicts, in the middle (by odds) of the gap it lies in.

    Each probability and label stands for so many ``rows``, one if not given.
    """
    if not (label == 1).any() or not (label == 0).any():
        return 0.5
    order = np.argsort(probability, kind="stable")
    p, y = np.clip(probability[order], 1e-6, 1 - 1e-6), label[order]
    n = np.ones(len(y), np.int64) if rows is None else rows[order]
    # the first i rows are called clean
    missed = np.concatenate([[0], np.cumsum(y * n)])
    wrong = np.concatenate([[0], np.cumsum((1 - y) * n)])
    cost = missed + CLEAN_COST * (wrong[-1] - wrong)
    split = np.concatenate([[True], p[1:] > p[:-1], [True]])
    best = int(np.where(split, cost, np.inf).argmin())
    if best == len(p):  # nothing is toxic
        return float((1 + probability.max()) / 2)
    ends = np.log([p[max(best - 1, 0)], p[min(best, len(p) - 1)]])
    low, high = ends - np.log1p(-np.exp(ends))
    return float(1 / (1 + np.exp(-(low + high) / 2)))


def informative(features: list[np.ndarray], label: np.ndarray, least: int = CHOSEN) -> np.ndarray:
    """The features whose shares among rows of the two labels differ most, sorted by number.

    The difference is measured against its standard error; ties go to the smaller number. All that
    differ by ``SURE`` standard errors are taken, and others down to 2 until there are ``least``. Of
    features beyond ``least`` that stand in the same rows (a word and its beginnings) one is taken, and
    of all these the best ``MOST_CHOSEN``.
    """
    def counts(rows: np.ndarray) -> np.ndarray:
        held = [features[i] for i in rows]
        return np.bincount(np.concatenate(held), minlength=SPACE) if held else np.zeros(SPACE, int)

    yes, no = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(yes) or not len(no):
        return np.zeros(0, np.uint32)
    a, b = counts(yes), counts(no)
    p = (a + b) / len(label)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / len(yes) + 1 / len(no)))
    z = np.abs(a / len(yes) - b / len(no)) / error
    z[a + b < 3] = 0
    order = np.argsort(-z, kind="stable")[: max(least, int((z > SURE).sum()))]
    if len(order) > least:
        # rows are told by random numbers, of which equal sets of rows have equal sums
        draw = np.random.default_rng(1).random(len(label))
        held = np.repeat(draw, [len(f) for f in features])
        rows = np.bincount(np.concatenate(features), weights=held, minlength=SPACE)[order]
        _, first = np.unique(np.round(rows, 6), return_index=True)
        new = np.zeros(len(order), bool)
        new[first] = True
        order = order[new | (np.arange(len(order)) < least)][: max(least, MOST_CHOSEN)]
    return np.sort(order[z[order] > 2]).astype(np.uint32)


def kinds_of(
    features: list[np.ndarray], chosen: np.ndarray, label: np.ndarray, kinds: int = KINDS
) -> np.ndarray:
    """A column per kind of toxic text, found by terms that occur together, and the label as the last.

    The strongest marking term starts a kind; it holds the toxic rows that share a marking term with
    the rows of the first. The next kind starts with the strongest term among the rows left.
    """
    x = Chain(chosen).rows(features)
    toxic = label == 1
    found = np.zeros((len(label), kinds + 1), np.int64)
    found[:, -1] = toxic
    if not toxic.any() or not len(chosen):
        return found
    share = x[~toxic].mean(axis=0) if (~toxic).any() else np.zeros(x.shape[1])
    marking = x[toxic].mean(axis=0) > 20 * (share + 1e-4)
    left = toxic.copy()
    for k in range(kinds):
        power = np.where(marking, x[left].sum(axis=0), 0)
        if not len(power) or power.max() < 5:
            break
        first = left & (x[:, int(power.argmax())] > 0)
        shared = marking & (x[first].mean(axis=0) > 0.1)
        found[:, k] = left & ((x[:, shared].sum(axis=1) > 0) | first)
        left &= found[:, k] == 0
    return found


def learn(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 9
) -> tuple[Chain, tuple[np.ndarray, np.ndarray], DataFrame]:
    """A chain from at most ``rows`` labelled documents, half of them toxic if there are as many.

    With it come the out-of-fold probabilities and labels of these, and ``(doc_id, label)`` of all
    labelled rows it did not learn from.
    """
    sample = labelled_sample(documents_of(docs), labels, "toxic", rows, seed)
    packed = F.pandas_udf(_packed, "binary")("text").alias("features")
    data = sample.select("doc_id", "label", packed).toPandas().sort_values("doc_id")
    features = [np.frombuffer(b, np.uint32) for b in data["features"]]
    label = data["label"].to_numpy(np.int64)
    chosen = informative(features, label)
    fold = np.array([zlib.crc32(f"{seed}:{d}".encode()) % FOLDS for d in data["doc_id"]], np.int64)
    chain, verdict = fit_links(features, chosen, kinds_of(features, chosen, label), fold)
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    ids = [(d,) for d in data["doc_id"].tolist()]
    learned = docs.sparkSession.createDataFrame(ids, sample.select("doc_id").schema)
    return chain, (verdict, label), known.join(F.broadcast(learned), "doc_id", "left_anti")


def cut_of(learned: tuple[np.ndarray, np.ndarray], others: DataFrame, scored: DataFrame) -> float:
    """The cut of least cost over all labelled rows: those learned from, and the ``others``.

    ``scored`` holds ``doc_id`` and ``toxicity`` of all documents. Only counts per step of the odds and
    label reach the driver.
    """
    probability, label = learned
    if others.isEmpty():
        return least_cost(probability, label)
    p = F.least(F.greatest(F.col("toxicity"), F.lit(1e-6)), F.lit(1 - 1e-6))
    step = F.floor((F.log(p) - F.log1p(-p)) / STEP).alias("step")
    counts = scored.join(others, "doc_id").groupBy(step, "label").agg(F.count(F.lit(1)).alias("n")).toPandas()
    odds = (counts["step"].to_numpy(np.float64) + 0.5) * STEP
    return least_cost(
        np.concatenate([probability, 1 / (1 + np.exp(-odds))]),
        np.concatenate([label, counts["label"].to_numpy(np.int64)]),
        np.concatenate([np.ones(len(label), np.int64), counts["n"].to_numpy(np.int64)]),
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, seed: int = 9) -> Chain:
    """The chain of ``learn`` with its cut."""
    chain, learned, others = learn(docs, labels, rows, seed)
    chain.cut = cut_of(learned, others, _scores(docs, chain))
    return chain


def _scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """``doc_id``, ``kinds`` and ``toxicity`` of every row."""
    scored = documents_of(docs).select("doc_id", probabilities(F.col("text"), chain).alias("kinds"))
    return scored.withColumn("toxicity", F.element_at("kinds", -1))


def probabilities(text: Column, chain: Chain) -> Column:
    """An array with the probability of each category in order; the last is the verdict's."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for batch in texts:
            out = []
            for at in range(0, len(batch), 1000):
                part = [features_of(t or "", terms) for t in batch[at : at + 1000]]
                out.extend(chain.predict(chain.rows(part)).tolist())
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<double>").asNondeterministic()(text)


def score(docs: DataFrame, labels: DataFrame, seed: int = 9) -> DataFrame:
    """Per document ``doc_id``, ``kinds`` (probabilities in chain order), ``toxicity`` and ``toxic``.

    The whole text decides; null counts as empty, and an empty text scores by the bias alone. Repeated
    rows are scored one by one; null ids and labels take no part in training. Without labels of both
    kinds nothing is toxic.
    """
    chain, learned, others = learn(docs, labels, seed=seed)
    scored = materialize(_scores(docs, chain), "toxicity")  # a few numbers per document
    cut = cut_of(learned, others, scored)
    return scored.withColumn("toxic", F.col("toxicity") >= cut)


def drop_toxic(docs: DataFrame, labels: DataFrame, seed: int = 9) -> DataFrame:
    """The rows of ``docs`` whose text is not toxic, with all their columns.

    The rows are stored with their score, as the cut is known only when all labelled rows have one.
    """
    chain, learned, others = learn(docs, labels, seed=seed)
    inner = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kinds = probabilities(text, chain)
    scored = docs.select(*inner, F.col("doc_id"), F.element_at(kinds, -1).alias("toxicity"))
    scored = materialize(scored, "toxicity")
    cut = cut_of(learned, others, scored.select("doc_id", "toxicity"))
    kept = scored.filter(F.col("toxicity") < cut)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
