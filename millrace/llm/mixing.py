"""Mixing sources to target weights by subset sums over document sizes.

How much a source may give is a budget in words. Whole rounds of the source (0 to 3) are taken first;
what is left of the budget is smaller than the source and is filled by a subset of its documents. The
subset is chosen by counts: documents of one size are alike, so the problem is a bounded knapsack over
(size, count) rows, of which there are at most as many as distinct sizes. The larger sizes are taken
in proportion, with the rounding error carried on to the next size, and the last few thousand words
are fitted exactly by dynamic programming. Which documents of a size go is decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.base import same, word_count
from millrace.operators.position import ordered_position
from millrace.session import materialize

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
# Words of the budget that are left to the knapsack; the proportional part stays below it.
FITTED_WORDS = 8192
# Documents of one source and size are ranked in so many parts by hash.
HASH_BITS = 12


def _shares(sources: DataFrame, most: int) -> DataFrame:
    """``target`` of each source: its weight's share of all words, at most ``most`` times its own.

    What a capped source can't take goes to the others by weight. Each pass raises the level (words
    per unit of weight) until no further source is capped; only two sums per pass reach the driver.
    """
    cap = (F.col("source_size") * most).cast("double")
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weights, level, capped = total or 0, weights or 1, total or 0, 0
    while True:
        over = cap * float(weights) <= F.col("weight") * float(level)
        held = sources.agg(
            F.count(F.when(over, 1)),
            F.sum(F.when(over, F.col("source_size"))),
            F.sum(F.when(~over, F.col("weight"))),
        ).first()
        if held[0] == capped or held[2] is None:
            break
        capped, level, weights = held[0], total - most * held[1], held[2]
    share = F.col("weight") * F.lit(float(level)) / F.lit(float(weights))
    return sources.withColumn("target", F.least(cap, share))


def fit(sizes: Sequence[int], counts: Sequence[int], budget: float) -> np.ndarray:
    """How many items of each size to take so that their sum comes nearest to ``budget``.

    Sizes are positive. Sizes from the largest down take their proportional share with the error
    carried along, short of the last ``FITTED_WORDS``; the rest is a bounded knapsack over what is
    left, in binary lots of 1, 2, 4 ... items of a size. ``first[s]`` is the lot that first reached
    the sum ``s``; going back along it gives the lots used.
    """
    sizes = np.asarray(sizes, np.int64)
    counts = np.asarray(counts, np.int64)
    taken = np.zeros(len(sizes), np.int64)
    if budget <= 0 or not len(sizes):
        return taken
    total = int((sizes * counts).sum())
    bulk = max(0.0, budget - FITTED_WORDS)
    owed = 0.0
    for i in np.argsort(-sizes, kind="stable"):
        owed += float(sizes[i] * counts[i]) * bulk / total
        taken[i] = min(counts[i], int(owed // sizes[i]))
        owed -= float(taken[i] * sizes[i])
    left = budget - float((taken * sizes).sum())
    spare = counts - taken
    usable = np.flatnonzero(spare > 0)
    if left < 0.5 or not len(usable):
        return taken
    reach = int(left) + int(sizes[usable].min())  # one step beyond, for a sum nearest from above
    first = np.full(reach + 1, -1, np.int64)
    first[0] = 0
    lots: list[tuple[int, int]] = [(0, 0)]
    aim = min(reach, round(left))
    for i in usable[np.argsort(sizes[usable], kind="stable")]:
        rest, lot = int(spare[i]), 1
        while rest > 0 and first[aim] < 0:
            lot = min(lot, rest)
            words = lot * int(sizes[i])
            if words > reach:
                break
            new = (first[:-words] >= 0) & (first[words:] < 0)
            first[words:][new] = len(lots)
            lots.append((int(i), lot))
            rest, lot = rest - lot, lot * 2
        if first[aim] >= 0:
            break
    sums = np.flatnonzero(first >= 0)
    at = int(sums[np.abs(sums - left).argmin()])
    while at:
        i, lot = lots[first[at]]
        taken[i] += lot
        at -= lot * int(sizes[i])
    return taken


def _plan(most: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        words, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
        rounds = min(most, int(target // words)) if words else 0
        real = (group["size"] > 0).to_numpy()
        extra = np.zeros(len(group), np.int64)
        if rounds < most and words:
            extra[real] = fit(group["size"][real], group["n"][real], target - rounds * words)
        return group[["source", "size", "source_size", "target"]].assign(rounds=rounds, extra=extra)

    return run


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_TIMES,
    seed: int = 11,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row ``doc_id, size, source_size, target, copies`` and ``taken = copies * size``.

    ``size`` is the number of words, 0 for null. Sources take the weights in turn by code point, the
    null source last, and share all words; no source gives more than ``most`` times its words, no
    document more than ``most`` copies. Rows without words are never copied (0 copies, unless their
    source is taken in whole rounds). ``keep`` names further columns to return, read from the same
    rows. Equal rows are interchangeable: of two rows alike, either may be the one taken, and the
    result is the same. Reruns agree, as the choice hangs on ids, the seed, and
    of equal ids on the texts.
    """
    sized = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.col("source").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 64 - HASH_BITS).alias("part"),
        F.xxhash64(F.lit(seed), F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("content"),
        F.struct(*[F.col(c) for c in keep]).alias("kept") if keep else F.lit(0).alias("kept"),
    )
    # only what the choice needs is stored; kept columns are read again from the input
    narrow = materialize(sized.drop("kept"), "sizes")
    counts = materialize(
        narrow.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    sources = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    placed = ordered_position(sources, [F.col("source").asc_nulls_last()], "place")
    steps = F.array(*[F.lit(int(w)) for w in weights])
    weighted = placed.withColumn(
        "weight", F.element_at(steps, (F.col("place") % len(weights) + 1).cast("int")).cast("bigint")
    ).drop("place")
    targets = _shares(materialize(weighted, "sources"), most)

    sizes = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    with_target = sizes.join(
        targets.withColumnRenamed("source", "of").drop("weight"), F.col("source").eqNullSafe(F.col("of"))
    ).drop("of")
    schema = with_target.select("source", "size", "source_size", "target").schema
    schema = schema.add("rounds", "long").add("extra", "long")
    plan = materialize(with_target.groupBy("source").applyInPandas(_plan(most), schema), "plan")

    # how many documents of the size lie in earlier parts; a part is then ranked on its own
    earlier = (
        Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    keys = ["source", "size"]
    parts = before.join(
        plan.select(*[F.col(k).alias(f"_{k}") for k in keys], "source_size", "target", "rounds", "extra"),
        same([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys]),
    ).drop("_source", "_size")
    keys.append("part")
    parts = parts.select(
        *[F.col(k).alias(f"_{k}") for k in keys], "before", "source_size", "target", "rounds", "extra"
    )
    ranked = Window.partitionBy("source", "size", "part").orderBy(
        F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "content"
    )
    rows = (sized if keep else narrow).withColumn("rank", F.row_number().over(ranked))
    joined = rows.join(parts, same([F.col(k) for k in keys], [F.col(f"_{k}") for k in keys]))
    copies = F.col("rounds") + F.when(F.col("before") + F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies.cast("bigint").alias("copies"),
        (copies * F.col("size")).cast("bigint").alias("taken"),
        *(["kept"] if keep else []),
    )


def mixed_documents(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The rows that the mix takes, each as often as it takes it, with the input's columns."""
    mixed = mix(docs, seed=seed, keep=docs.columns)
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.filter(F.col("copies") > 0).select("kept", F.explode(times)).select("kept.*")
