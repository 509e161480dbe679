"""Nearest neighbours by largest inner product, through a hierarchical k-means tree.

The tree is grown on a bounded sample and sent to all tasks; every row is put into its leaf. A query
walks the tree best bin first: of all nodes seen so far the one whose centre has the largest inner
product is opened next, until enough leaves are visited. How many are enough is measured: for some of
the queries the true neighbours are found by brute force over all rows, and the visits are widened
until the wanted share of them lies in visited leaves.

Leaves are dealt into parts of bounded size, large leaves over several, and each part meets the
queries that visit one of its leaves, in blocks of queries that lie near each other. A part returns its
best few per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

NEAREST = 20
SAMPLE_ROWS = 10_000
BRANCHES = 8
LEAF_ROWS = 24
ROUNDS = 8
# Queries whose true neighbours are found by brute force, and the share of these to be reached.
CALIBRATION = 128
RECALL = 0.94
PART_ROWS = 8192
QUERY_BLOCK = 8192
# Queries that one task walks through the tree.
ROUTED_ROWS = 2048
# Products are formed for so many pairs at a time.
PAIRS = 1 << 21


@dataclass
class Tree:
    """Nodes as arrays: centre, first child and number of children; leaves have none and a number."""

    centre: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: from the root to the nearest child each time."""
        node = np.zeros(len(x), np.int64)
        while (open_ := np.flatnonzero(self.children[node] > 0)).size:
            for parent in np.unique(node[open_]):
                rows = open_[node[open_] == parent]
                span = slice(self.first[parent], self.first[parent] + self.children[parent])
                c = self.centre[span]
                far = (c * c).sum(axis=1) - 2 * x[rows] @ c.T
                node[rows] = self.first[parent] + far.argmin(axis=1)
        return self.leaf[node]

    def visits(self, query: np.ndarray, most: int, size: np.ndarray | None = None, rows: int = 0) -> list[int]:
        """The first ``most`` leaves in best-bin-first order, and more until they hold ``rows`` rows.

        ``size`` is the number of rows of each leaf; without it rows do not count.
        """
        product = self.centre @ query
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < most or (size is not None and held < rows)):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(int(self.leaf[node]))
                held += 0 if size is None else int(size[found[-1]])
                continue
            for child in range(self.first[node], self.first[node] + self.children[node]):
                heapq.heappush(queue, (-float(product[child]), child))
        return found


def _means(x: np.ndarray, k: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centre = x[random.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = ((centre * centre).sum(axis=1) - 2 * x @ centre.T).argmin(axis=1)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
    near = ((centre * centre).sum(axis=1) - 2 * x @ centre.T).argmin(axis=1)
    return centre, near


def grow(x: np.ndarray, seed: int = 13) -> Tree:
    """A tree over the sample; a node of few or only equal rows is a leaf."""
    random = np.random.default_rng(seed)
    centre, first, children = [x.mean(axis=0)], [0], [0]
    waiting = [(0, x)]
    while waiting:
        node, rows = waiting.pop(0)
        if len(rows) <= LEAF_ROWS or (rows == rows[0]).all():
            continue
        means, near = _means(rows, min(BRANCHES, len(rows)), random)
        used = np.unique(near)
        if len(used) < 2:
            continue
        first[node], children[node] = len(centre), len(used)
        for k in used:
            waiting.append((len(centre), rows[near == k]))
            centre.append(means[k])
            first.append(0)
            children.append(0)
    many = np.array(children)
    leaf = np.full(len(many), -1)
    # leaves are numbered depth first, so that near leaves have near numbers
    stack, number = [0], 0
    while stack:
        node = stack.pop()
        if many[node]:
            stack.extend(range(first[node] + many[node] - 1, first[node] - 1, -1))
        else:
            leaf[node] = number
            number += 1
    return Tree(np.array(centre), np.array(first), many, leaf)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _best(
    queries: np.ndarray, ids: np.ndarray, x: np.ndarray, own: np.ndarray, k: int, open_: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``x`` for each query: query number, row number, score.

    ``own`` are the queries' ids, whose rows are left out; ``open_`` marks the pairs that count. Of
    equal vectors only the ``k + 1`` with the smallest ids can be among the best. Products of the
    whole block choose the pairs; their scores are then summed anew, each pair in the same order
    whatever block it is in, so that equal vectors have equal scores and ties go by id.
    """
    words = np.ascontiguousarray(x).view(np.uint64)
    order = np.lexsort([ids, *words.T])
    same = np.zeros(len(order), bool)
    same[1:] = (words[order][1:] == words[order][:-1]).all(axis=1)
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    # the copies of one id may all be the query's own
    alike = np.concatenate([[False], same[1:] & (ids[order][1:] == ids[order][:-1])]) if len(order) else same
    copies = np.arange(len(order)) - np.maximum.accumulate(np.where(alike, 0, np.arange(len(order))))
    most = np.zeros(len(order), np.int64)
    np.maximum.at(most, start, copies)
    rows = np.sort(order[np.arange(len(order)) - start - most[start] <= k])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, PAIRS // max(1, len(rows)))
    norm = np.sqrt((x[rows] ** 2).sum(axis=1)).max() if len(rows) else 0.0
    for at in range(0, len(queries), step):
        q = queries[at : at + step]
        products = q @ x[rows].T
        products[own[at : at + step, None] == ids[rows]] = -np.inf
        if open_ is not None:
            products[~open_[at : at + step][:, rows]] = -np.inf
        if len(rows) > k:
            least = np.partition(products, len(rows) - k, axis=1)[:, len(rows) - k]
        else:
            least = np.full(len(q), -np.inf)
        slack = 1e-9 * np.sqrt((q**2).sum(axis=1)) * norm
        near = (products >= (least - slack)[:, None]) & (products > -np.inf)
        qi, ri = np.nonzero(near)
        score = np.empty(len(qi))
        for part in range(0, len(qi), 1 << 16):
            span = slice(part, part + (1 << 16))
            score[span] = (q[qi[span]] * x[rows[ri[span]]]).sum(axis=1)
        order = np.lexsort([ids[rows[ri]], -score, qi])
        qi, ri, score = qi[order], ri[order], score[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        keep = rank < k
        found.append((qi[keep] + at, rows[ri[keep]], score[keep]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))  # type: ignore[return-value]


def _placed(tree: Tree):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.array([np.asarray(v, np.float64) for v in batch["vector"]])
            yield pd.DataFrame(
                {"vec_id": batch["vec_id"], "leaf": tree.place(x), "vector": [v.tobytes() for v in x]}
            )

    return run


def _brute(ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, rows = _matrix(batch["vector"]), batch["vec_id"].to_numpy()
            q, r, score = _best(queries, rows, x, ids, k, None)
            yield pd.DataFrame(
                {"query_id": ids[q], "vec_id": rows[r], "leaf": batch["leaf"].to_numpy()[r], "score": score}
            )

    return run


def _top(found: DataFrame, k: int, *query: str) -> DataFrame:
    by_score = Window.partitionBy("query_id", *query).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)


def brute_force(placed: DataFrame, queries: pd.DataFrame, k: int = NEAREST) -> DataFrame:
    """The true neighbours of a bounded set of queries over all rows of the index."""
    run = _brute(queries["vec_id"].to_numpy(), _matrix(queries["vector"]), k)
    found = placed.mapInPandas(run, "query_id bigint, vec_id bigint, leaf bigint, score double")
    return _top(found, k)


def calibrate(tree: Tree, placed: DataFrame, queries: DataFrame, k: int, recall: float) -> tuple[int, float]:
    """Leaves to visit so that ``recall`` of the true neighbours of some queries are reached."""
    single = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    some = single.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    if not len(some):
        return 1, 1.0
    truth = brute_force(placed, some, k).select("query_id", "leaf").toPandas()
    if not len(truth):
        return 1, 1.0
    place = {}
    for vec_id, vector in zip(some["vec_id"], _matrix(some["vector"]), strict=True):
        for rank, leaf in enumerate(tree.visits(vector, tree.leaves)):
            place[vec_id, leaf] = rank
    needed = np.array([place[q, leaf] for q, leaf in truth.itertuples(index=False)])
    most = 1
    while (needed < most).mean() < recall:  # widen by an eighth at a time
        most += max(1, most // 8)
    return most, float((needed < most).mean())


def _routed(tree: Tree, most: int, size: np.ndarray, k: int, parts: np.ndarray, offsets: np.ndarray):
    """Queries to the parts where they visit leaves, once per part, with a bit per leaf.

    The leaves hold at least ``k`` rows beside those with the query's id, if the table does.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            named = zip(*[batch[c] for c in ("vec_id", "copy", "block", "vector", "own")], strict=True)
            for vec_id, copy, block, raw, own in named:
                leaves = np.array(tree.visits(np.frombuffer(raw, np.float64), most, size, k + own))
                visited = np.zeros(tree.leaves, bool)
                visited[leaves] = True
                bits = np.packbits(visited).tobytes()
                used = {p for leaf in leaves for p in range(offsets[leaf], offsets[leaf] + parts[leaf])}
                # consecutive small leaves share a part, so several leaves may name the same one
                rows += [(p, block, vec_id, copy, raw, bits) for p in sorted(used)]
            yield pd.DataFrame(rows, columns=["part", "block", "query_id", "copy", "vector", "bits"])

    return run


def _searched(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "copy": [], "vec_id": [], "score": []})
        bits = np.frombuffer(b"".join(queries["bits"]), np.uint8).reshape(len(queries), -1)
        visited = np.unpackbits(bits, axis=1).astype(bool)
        ids, own = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        open_ = visited[:, rows["leaf"].to_numpy()]
        q, r, score = _best(_matrix(queries["vector"]), ids, _matrix(rows["vector"]), own, k, open_)
        copy = queries["copy"].to_numpy()
        return pd.DataFrame({"query_id": own[q], "copy": copy[q], "vec_id": ids[r], "score": score})

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEAREST,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 13,
) -> DataFrame:
    """Each query's ``k`` nearest found: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Candidates are all rows but those with the query's id; nearness is the inner product in double
    precision, ties go to the smaller id. Vectors that are null or zero or hold null or non-finite
    components take no part, nor do null ids and vectors that are not as long as most. Every query
    visits ``leaves_visited`` leaves, and more where these hold fewer than ``k`` candidates. Fewer than
    ``k`` candidates in the table: all of them. An empty table gives an empty result.

    Repeated rows: equal queries (id and vector) are answered once, queries of one id with different
    vectors each on their own, and a candidate row is named as often as it is in the table.
    """
    spark = vectors.sparkSession
    flagged = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = flagged.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = flagged.filter(F.size("vector") == lengths["n"])
    sample = (
        rows.select("vec_id", "vector")
        .orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id", "vector")
        .limit(SAMPLE_ROWS)
        .toPandas()
    )
    tree = grow(np.array([np.asarray(v, np.float64) for v in sample["vector"]]), seed)
    index = materialize(
        rows.select("vec_id", "vector").mapInPandas(
            _placed(tree), "vec_id bigint, leaf bigint, vector binary"
        ),
        "index",
    )
    asking = materialize(
        rows.filter("is_query")
        .select("vec_id", "vector")
        .mapInPandas(_placed(tree), "vec_id bigint, leaf bigint, vector binary")
        .dropDuplicates(["vec_id", "vector"])
        .withColumn("copy", F.xxhash64("vector")),
        "queries",
    )
    most, reached = calibrate(tree, index, asking, k, recall)

    # one count per leaf: as many rows as the tree has leaves
    size = np.zeros(tree.leaves, np.int64)
    for leaf, n in index.groupBy("leaf").count().collect():
        size[leaf] = n
    parts = np.maximum(1, -(-size // PART_ROWS))
    offsets, at, filled = np.zeros(tree.leaves, np.int64), 0, 0
    for leaf in range(tree.leaves):
        if parts[leaf] > 1 or filled + size[leaf] > PART_ROWS:
            at, filled = at + (filled > 0), 0
        offsets[leaf] = at
        filled += size[leaf]
        if parts[leaf] > 1:
            at, filled = at + parts[leaf], 0
    # queries are dealt by their own leaf: near queries visit the same leaves, and a block few parts
    asked = np.zeros(tree.leaves, np.int64)
    for leaf, n in asking.groupBy("leaf").count().collect():
        asked[leaf] = n
    total = int(asked.sum())
    first = np.cumsum(asked) - asked
    spans = spark.createDataFrame(pd.DataFrame({"at": np.arange(tree.leaves), "before": first, "asked": asked}))
    within = F.pmod(F.xxhash64(F.lit(seed + 1), "vec_id", "copy"), F.greatest("asked", F.lit(1)))
    block = F.floor((F.col("before") + within) / QUERY_BLOCK).alias("block")
    # rows with the query's id are none of its candidates
    own = index.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own"))
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // ROUTED_ROWS))
    routed = asking.join(F.broadcast(spans), F.col("leaf") == F.col("at")).join(own, "vec_id")
    routed = materialize(
        routed.select("vec_id", "copy", block, "vector", "own")
        .repartition(tasks)
        .mapInPandas(
            _routed(tree, most, size, k, parts, offsets),
            "part bigint, block bigint, query_id bigint, copy bigint, vector binary, bits binary",
        ),
        "routed",
    )
    layout = spark.createDataFrame(
        pd.DataFrame({"of": np.arange(tree.leaves), "first": offsets, "parts": parts})
    )
    # a row goes to the blocks that visit its part, and to no other
    visits = routed.select(F.col("part").alias("to"), F.col("block").alias("by")).distinct()
    dealt = (
        index.join(F.broadcast(layout), F.col("leaf") == F.col("of"))
        .select((F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).alias("part"), "vec_id", "leaf", "vector")
        .join(visits, F.col("part") == F.col("to"))
        .select("part", F.col("by").alias("block"), "vec_id", "leaf", "vector")
    )
    found = (
        routed.groupBy("part", "block")
        .cogroup(dealt.groupBy("part", "block"))
        .applyInPandas(_searched(k), "query_id bigint, copy bigint, vec_id bigint, score double")
    )
    return _top(found, k, "copy").select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        "vec_id",
        "score",
        F.lit(most).alias("leaves_visited"),
        F.lit(reached).alias("calibrated_recall"),
    )
