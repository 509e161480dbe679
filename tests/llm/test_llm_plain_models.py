"""Forest, ranking and chain against plain loops over rows and weights."""

import math

import numpy as np
import pytest

from millrace.llm import quality_classifier as ranking
from millrace.llm import quality_rules as rules
from millrace.llm import toxicity


def data(seed, rows=120, columns=5):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((rows, columns)) * [1, 2, 0.5, 3, 1][:columns]
    label = (x[:, 0] + 0.3 * rng.standard_normal(rows) > -0.5).astype(np.int64)
    return x, label


def plain_path(forest, row):
    total = 0.0
    for feature, cut, left, path in zip(forest.feature, forest.cut, forest.left, forest.path, strict=True):
        node = 0
        while feature[node] >= 0:
            node = int(left[node]) + int(row[feature[node]] >= cut[node])
        total += path[node]
    return total / len(forest.feature)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_path_lengths_match_a_walk_through_every_tree(seed):
    x, _ = data(seed)
    forest = rules.grow(x, x.max(axis=0) - x.min(axis=0), seed=seed)
    far = np.vstack([x, 50 * x[:10], np.zeros((1, x.shape[1]))])
    assert forest.paths(far).tolist() == pytest.approx([plain_path(forest, row) for row in far])
    # a leaf's length is its depth and the mean path of the rows that it still holds
    for tree in range(3):
        held = {0: (np.arange(len(x)), 0)}
        feature, cut, left = forest.feature[tree], forest.cut[tree], forest.left[tree]
        depths = {0: 0}
        for node in range(len(feature)):
            if node in depths and feature[node] >= 0:
                depths[left[node]] = depths[left[node] + 1] = depths[node] + 1
        leaves = [n for n in depths if feature[n] < 0]
        assert all(forest.path[tree][n] >= depths[n] for n in leaves) and held
    assert np.median(forest.paths(50 * x)) < np.median(forest.paths(x))


def plain_strength(x, label, seed):
    """The same pairs and steps with loops over pairs and weights."""
    model = ranking.fit_strength(x, label, seed)
    features = model.features(x).tolist()
    random = np.random.default_rng(seed)
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    first, second = random.choice(better, ranking.PAIRS), random.choice(worse, ranking.PAIRS)
    pairs = [[a - b for a, b in zip(features[i], features[j], strict=True)] for i, j in zip(first, second, strict=True)]
    weights = [0.0] * len(pairs[0])
    speed = list(weights)
    for _ in range(ranking.STEPS):
        gradient = [ranking.RIDGE * w for w in weights]
        for pair in pairs:
            wrong = 1 / (1 + math.exp(min(50, max(-50, sum(p * w for p, w in zip(pair, weights, strict=True))))))
            for k, p in enumerate(pair):
                gradient[k] -= wrong * p / len(pairs)
        speed = [0.9 * s - ranking.RATE * g / 10 for s, g in zip(speed, gradient, strict=True)]
        weights = [w + s for w, s in zip(weights, speed, strict=True)]
    return model, weights


def test_pairwise_ranking_matches_plain_gradient_descent(monkeypatch):
    monkeypatch.setattr(ranking, "PAIRS", 200)
    monkeypatch.setattr(ranking, "STEPS", 25)
    x, label = data(4, columns=3)
    model, weights = plain_strength(x, label, 7)
    assert model.weights.tolist() == pytest.approx(weights, rel=1e-6, abs=1e-9)
    strength = model.strength(x)
    won = np.mean([a > b for a in strength[label == 1] for b in strength[label == 0]])
    assert won > 0.9


@pytest.mark.parametrize("seed", range(6))
def test_quantile_of_least_cost(seed):
    rng = np.random.default_rng(seed)
    strength = np.round(rng.standard_normal(80), 1)
    label = (strength + rng.standard_normal(80) > 0).astype(np.int64)
    rows = rng.integers(1, 4, 80).astype(np.float64)
    model = ranking.Strength(np.zeros(1), np.ones(1), np.zeros(3))
    ranking.choose_quantile(model, strength, label, rows)

    def cost(cut):
        lost = sum(n for s, y, n in zip(strength, label, rows, strict=True) if y == 1 and s < cut)
        left = sum(n for s, y, n in zip(strength, label, rows, strict=True) if y == 0 and s >= cut)
        return ranking.CLEAN_COST * lost + left

    every = np.repeat(strength, rows.astype(int))
    every.sort()
    quantiles = {every[min(len(every) - 1, math.ceil(len(every) * q / ranking.QUANTILES) - 1)] for q in range(1, ranking.QUANTILES)}
    assert cost(model.cut) == pytest.approx(min(cost(c) for c in quantiles))


def plain_link(x, earlier, label):
    n, positive = len(label), int(sum(label))
    both = [list(a) + list(b) for a, b in zip(x.tolist(), earlier.tolist(), strict=True)]
    ridge = [toxicity.RIDGE] * (x.shape[1] + earlier.shape[1])
    weights, bias = [0.0] * len(ridge), 0.0
    speed, push = [0.0] * len(ridge), 0.0
    for _ in range(toxicity.STEPS):
        gradient, step = [r * w for r, w in zip(ridge, weights, strict=True)], 0.0
        for row, y in zip(both, label, strict=True):
            z = sum(v * w for v, w in zip(row, weights, strict=True)) + bias
            error = (1 / (1 + math.exp(-min(30, max(-30, z)))) - y) * (0.5 / positive if y else 0.5 / (n - positive))
            step += error
            for k, v in enumerate(row):
                gradient[k] += v * error
        speed = [0.9 * s - toxicity.RATE * g for s, g in zip(speed, gradient, strict=True)]
        push = 0.9 * push - toxicity.RATE * step
        weights, bias = [w + s for w, s in zip(weights, speed, strict=True)], bias + push
    return weights, bias


def plain_probability(model, row):
    weights, bias = model
    return 1 / (1 + math.exp(-min(30, max(-30, sum(v * w for v, w in zip(row, weights, strict=True)) + bias))))


def test_chain_matches_plain_models_with_out_of_fold_predictions(monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 20)
    rng = np.random.default_rng(3)
    features = [np.unique(rng.choice(6, rng.integers(0, 5))).astype(np.uint32) for _ in range(60)]
    chosen = np.arange(6, dtype=np.uint32)
    held = np.array([[c in f for c in chosen] for f in features], np.float64)
    labels = np.column_stack([held[:, 0], (held[:, 0] + held[:, 1] > 0)]).astype(np.int64)
    fold = np.arange(60) % 3
    chain, verdict = toxicity.fit_links(features, chosen, labels, fold)
    outside = np.zeros((60, 0))
    models = []
    for k in range(2):
        predicted = np.zeros(60)
        for f in range(3):
            inside = fold != f
            part = plain_link(held[inside], outside[inside], labels[inside, k].tolist())
            for i in np.flatnonzero(~inside):
                predicted[i] = plain_probability(part, [*held[i], *outside[i]])
        models.append(plain_link(held, outside, labels[:, k].tolist()))
        outside = np.column_stack([outside, predicted])
    assert verdict.tolist() == pytest.approx(outside[:, -1].tolist(), rel=1e-4)
    out = chain.predict(chain.rows(features))
    for i, row in enumerate(held.tolist()):
        first = plain_probability(models[0], row)
        assert out[i].tolist() == pytest.approx([first, plain_probability(models[1], [*row, first])], rel=1e-4)


@pytest.mark.parametrize("seed", range(6))
def test_cut_of_least_cost(seed):
    rng = np.random.default_rng(seed)
    probability = np.round(rng.uniform(0.02, 0.98, 60), 2)
    label = (probability + 0.4 * rng.standard_normal(60) > 0.5).astype(np.int64)
    rows = rng.integers(1, 5, 60)

    def cost(cut):
        missed = rows[(label == 1) & (probability < cut)].sum()
        return missed + toxicity.CLEAN_COST * rows[(label == 0) & (probability >= cut)].sum()

    best = min(cost(c) for c in [*np.unique(probability), 2.0])
    assert cost(toxicity.least_cost(probability, label, rows)) == best


def test_a_lexicon_of_some_hundred_words_is_learned_whole(spark):
    rng = np.random.default_rng(11)
    plain = [f"word{i}" for i in range(3000)]
    bad = ["".join(rng.choice(list("bcdfghjklmnprstvz"), 7)) for _ in range(200)]
    rows, labels = [], []
    for i in range(4000):
        words = rng.choice(plain, 30).tolist()
        toxic = i % 2
        if toxic:
            words += rng.choice(bad, 4).tolist()
        rows.append((i, " ".join(words)))
        if i < 3000:
            labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = toxicity.score(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    later = {r["doc_id"]: r["toxic"] for r in found.filter("doc_id >= 3000").collect()}
    assert np.mean([later[i] for i in later if i % 2]) > 0.97
    assert np.mean([later[i] for i in later if not i % 2]) < 0.02
