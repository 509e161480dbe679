"""Mixing: the fit against all subsets, targets against the rule, and odd rows."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import mixing


@pytest.mark.parametrize("seed", range(40))
def test_fit_comes_as_near_as_any_subset(seed):
    rng = random.Random(seed)
    sizes = rng.sample(range(1, 40), rng.randint(1, 5))
    counts = [rng.randint(1, 3) for _ in sizes]
    budget = rng.uniform(0, sum(s * c for s, c in zip(sizes, counts, strict=True)))
    taken = mixing.fit(sizes, counts, budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
    sums = {
        sum(s * k for s, k in zip(sizes, ks, strict=True))
        for ks in itertools.product(*[range(c + 1) for c in counts])
    }
    best = min(abs(s - budget) for s in sums)
    assert abs(int((taken * np.array(sizes)).sum()) - budget) == pytest.approx(best)


def test_fit_of_a_large_budget_is_exact():
    rng = np.random.default_rng(1)
    sizes = np.unique(rng.integers(1, 20_000, 800))
    counts = rng.integers(1, 50, len(sizes))
    budget = float((sizes * counts).sum()) * 0.37
    taken = mixing.fit(sizes, counts, budget)
    assert abs((taken * sizes).sum() - budget) <= 1 and (taken <= counts).all()
    # the large sizes are taken in proportion, not all or none
    large = sizes > 10_000
    assert 0.3 < taken[large].sum() / counts[large].sum() < 0.45


def targets(sizes, most=3):
    """The rule in fractions: share by weight, cap, and share what is left among the others."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    result, open_, left = {}, set(names), Fraction(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**result, **share}
        for s in over:
            result[s] = Fraction(most * sizes[s])
            left -= result[s]
            open_.remove(s)


def test_targets_copies_and_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        source = rng.choice(["a", "a", "a", "b", "c", "é", "Z", None])
        rows.append((i, " ".join(["w"] * rng.randint(0, 30)), source, "x", 1))
    rows += [(1000, "one two\x0bthree still", "tiny", "x", 1), (1001, None, "none", "x", 1)]
    rows += [(2007, "same row", "a", "x", 1), (2007, "same row", "a", "x", 1), (None, "no id", "b", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, n int")
    found = mixing.mix(docs).toPandas()
    assert len(found) == len(rows)
    total = {}
    for _, text, source, *_ in rows:
        total[source] = total.get(source, 0) + len((text or "").encode().split())
    expected = targets(total)
    source = {r[0]: r[2] for r in rows}
    found["source"] = [source[None if i != i else int(i)] for i in found.doc_id]
    for name, part in found.groupby("source", dropna=False):
        name = None if name != name else name
        assert part.source_size.unique().tolist() == [total[name]]
        assert part.target.iloc[0] == pytest.approx(float(expected[name]))
        assert (part.taken <= 3 * part["size"]).all()
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 3, name
    again = mixing.mix(docs).toPandas()
    order = ["doc_id", "size", "taken"]
    assert found[order].sort_values(order).values.tolist() == again[order].sort_values(order).values.tolist() or (
        found[order].fillna(-1).sort_values(order).values.tolist()
        == again[order].fillna(-1).sort_values(order).values.tolist()
    )
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == found.copies.sum()


def test_one_size_of_one_source_spreads_over_parts(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'a b c' as text", "if(id < 4000, 'a', 'b') as source")
    found = mixing.mix(docs).toPandas()
    taken = found.groupby("source_size").taken.sum()
    assert abs(taken[12000] - found[found.source_size == 12000].target.iloc[0]) <= 2
    assert abs(taken[3000] - found[found.source_size == 3000].target.iloc[0]) <= 2


def test_empty_tables_and_texts(spark):
    schema = "doc_id bigint, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema)).toPandas()
    assert blank.taken.tolist() == [0, 0] and blank.target.tolist() == [0.0, 0.0]
