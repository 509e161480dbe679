"""Neighbour search against brute force, with ties and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours
from millrace.llm.queries import op5_neighbours, table


def brute(ids, x, query, k=20):
    i = int(np.flatnonzero(ids == query)[0])
    score = (x * x[i]).sum(axis=1)
    score[ids == query] = -np.inf
    order = np.lexsort([ids, -score])[: min(k, (ids != query).sum())]
    return ids[order].tolist(), score[order].tolist()


def test_recall_ranks_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    found = op5_neighbours(spark, folder).toPandas()
    rows = table(spark, folder, "embeddings").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64)
    hits = 0
    groups = dict(list(found.groupby("query_id")))
    assert set(groups) == set(ids[ids % 20 == 0])
    for query, part in groups.items():
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21))
        place = {v: (x[i] * x[ids == query][0]).sum() for i, v in enumerate(ids)}
        assert part.score.tolist() == [place[v] for v in part.vec_id]
        assert list(zip(-part.score, part.vec_id, strict=True)) == sorted(zip(-part.score, part.vec_id, strict=True))
        hits += len(set(part.vec_id) & set(brute(ids, x, query)[0]))
    assert hits / (20 * len(groups)) >= 0.9


def test_equal_vectors_split_leaves_and_invalid_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((900, 6))
    x[200:700] = x[200]  # more equal rows than a part holds
    data = [(i, v.tolist(), "a", 1) for i, v in enumerate(x)]
    bad = [None, [], [0.0] * 6, [float("nan")] * 6, [float("inf")] + [1.0] * 5, [None, 1.0, 1.0, 1.0, 1.0, 1.0], [1.0] * 3]
    data += [(1000 + 20 * i, v, "a", 1) for i, v in enumerate(bad)] + [(None, [1.0] * 6, "a", 1)]
    schema = "vec_id bigint, embedding array<double>, leaf string, part int"
    vectors = spark.createDataFrame(data, schema)
    found = neighbours.search(vectors, F.col("vec_id") % 20 == 0, recall=1.0).toPandas()
    ids = np.arange(900)
    hits = 0
    for query, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        expected, score = brute(ids, x, query)
        hits += len(set(expected) & set(part.vec_id))
        if part.vec_id.tolist() == expected:
            assert part.score.tolist() == pytest.approx(score)
        ties = part[part.vec_id.between(200, 699)]
        assert ties.score.nunique() <= 1
        # of equal rows those with the smallest ids come, in order
        equal = [i for i in range(200, 700) if i != query][: len(ties)]
        assert ties.vec_id.tolist() == equal
    assert found.query_id.nunique() == 45 and hits >= 0.95 * 45 * 20


def test_few_rows_and_empty_table(spark):
    schema = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], schema)
    found = neighbours.search(few, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert neighbours.search(one, F.col("vec_id") == 0).count() == 0
    assert neighbours.search(spark.createDataFrame([], schema), F.col("vec_id") == 0).count() == 0


def test_best_bin_first_opens_all_leaves_in_the_end():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 4))
    tree = neighbours.grow(x)
    assert sorted(tree.visits(x[0], tree.leaves)) == list(range(tree.leaves))
    assert set(tree.place(x)) <= set(range(tree.leaves))
    assert neighbours.grow(np.ones((50, 3))).leaves == 1


def test_thin_leaves_and_lone_rows_still_find_all_they_should(spark, monkeypatch):
    # tight clusters, for which one leaf is enough, and lone rows far from all others as queries
    rng = np.random.default_rng(4)
    centre = 10 * rng.standard_normal((30, 8))
    x = np.concatenate([np.repeat(centre, 60, axis=0) + 0.01 * rng.standard_normal((1800, 8)), 300 * rng.standard_normal((20, 8))])
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1819, x[1819].tolist())] * 30
    vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(neighbours, "calibrate", lambda *_: (1, 1.0))
    found = neighbours.search(vectors, F.col("vec_id") >= 1800).toPandas()
    # a repeated query is answered once, with the best of what its rows found
    assert found.groupby("query_id").size().to_dict() == dict.fromkeys(range(1800, 1820), 20)
    # a table of several leaves with fewer rows than asked for: all of them
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 2)
    few = spark.createDataFrame(data[:1] + data[60:1800:200], "vec_id bigint, embedding array<double>")
    assert neighbours.search(few, F.col("vec_id") == 0).count() == few.count() - 1


def test_repeated_rows_are_candidates_but_not_queries_of_their_own(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 6))
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    schema = "vec_id bigint, embedding array<double>"
    is_query = F.col("vec_id") % 20 == 0
    once = neighbours.search(spark.createDataFrame(data, schema), is_query, recall=1.0).toPandas()
    asked = [r for r in data if r[0] % 20 == 0]
    more = neighbours.search(spark.createDataFrame(data + asked * 2, schema), is_query, recall=1.0).toPandas()
    twice = neighbours.search(spark.createDataFrame(data + data, schema), is_query, recall=1.0).toPandas()
    for query in range(0, 400, 20):
        expected, _ = brute(np.arange(400), x, query)
        lists = [t[t.query_id == query].sort_values("rank").vec_id.tolist() for t in (once, more, twice)]
        assert lists[0] == expected
        # other queries are three rows each there
        kept = [v for v in expected for _ in range(3 if v % 20 == 0 else 1)][:20]
        assert lists[1] == kept
        assert lists[2] == [v for v in expected for _ in range(2)][:20]


def test_one_id_with_two_vectors_is_two_queries(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((100, 4))
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, (-x[0]).tolist())]
    vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    found = neighbours.search(vectors, F.col("vec_id") == 0, k=5, recall=1.0).collect()
    score = x[1:] @ x[0]
    expected = sorted([*np.sort(score)[-5:].tolist(), *np.sort(-score)[-5:].tolist()])
    assert sorted(r["score"] for r in found) == pytest.approx(expected)
    assert sorted(r["rank"] for r in found) == sorted([*range(1, 6)] * 2)


def test_many_own_copies_hide_no_other_row(spark):
    data = [(7, [1.0, 2.0])] * 40 + [(8, [1.0, 2.0])] * 3 + [(9, [0.5, 0.5])]
    vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    found = neighbours.search(vectors, F.col("vec_id") == 7, k=4).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [8, 8, 8, 9]
