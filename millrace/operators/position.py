"""Global positions and rank cuts without a window over the whole table.

An unpartitioned window moves every row into one task. Here a position is the sum of two parts: how
many rows the buckets before this one hold (one small table), and the rank inside the bucket. Where
only a cut is needed ("the first 80 %"), no row is ranked at all: the key at the cut is found by
counting, and the cut becomes a filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import null_safe_join
from millrace.session import materialize

# Buckets of one counting pass, about; their counts are the only rows that reach the driver.
PASS_BUCKETS = 4096
# A bucket this small is sorted to read off the key at a rank.
SORT_ROWS = 10_000
# The leading hex digits of the hash that form the rank bucket: 65,536 buckets.
HASH_DIGITS = 4


def hash_key(seed: object, keys: Sequence[str]) -> Column:
    """The hash by which rows are permuted: md5 of the seed and the row's key.

    ``seed`` may be a column, to permute groups of rows differently.
    """
    first = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", first, *[F.col(k).cast("string") for k in keys]))


class RankIndex:
    """Finds the keys at given ranks by repeated counting.

    ``bucket(level)`` gives ever finer buckets of the order, about ``PASS_BUCKETS`` per bucket of
    the level above; ``order`` tells rows of one bucket apart and must be unique. Each pass counts
    the buckets inside those that hold a wanted rank. Nothing is shuffled but the counts.
    """

    def __init__(
        self, df: DataFrame, bucket: Callable[[int], Column], order: Sequence[Column], levels: int
    ) -> None:
        self._df, self._bucket, self._order, self._levels = df, bucket, list(order), levels
        self._first = self._counts(df.select(bucket(1).alias("b")))
        self.count = sum(n for _, n in self._first)

    @staticmethod
    def _counts(buckets: DataFrame) -> list[tuple[Any, int]]:
        rows = buckets.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
        return sorted((row["b"], row["n"]) for row in rows)

    @staticmethod
    def _descend(counts: Sequence[tuple[Any, int]], rank: int) -> tuple[Any, int, int]:
        """The bucket that holds ``rank``, the rank inside it, and its rows."""
        for bucket, n in counts:
            if rank < n:
                return bucket, rank, n
            rank -= n
        raise IndexError("rank beyond the rows")

    def keys_at(self, ranks: Sequence[int]) -> dict[int, tuple[Any, ...]]:
        """The order values of the rows at 0-based ``ranks``."""
        if not ranks:
            return {}
        places = {rank: self._descend(self._first, rank) for rank in ranks}
        level = 1
        while level < self._levels and max(n for _, _, n in places.values()) > SORT_ROWS:
            upper, finer = self._bucket(level), self._bucket(level + 1)
            held = sorted({bucket for bucket, _, _ in places.values()})
            inside = self._df.filter(upper.isin(held))
            rows = inside.groupBy(upper.alias("u"), finer.alias("b")).agg(
                F.count(F.lit(1)).alias("n")
            ).collect()
            counts = sorted((row["u"], row["b"], row["n"]) for row in rows)
            places = {
                rank: self._descend([(b, n) for u, b, n in counts if u == bucket], place)
                for rank, (bucket, place, _) in places.items()
            }
            level += 1
        # what is left to sort is small: at most SORT_ROWS rows per wanted rank
        bucket = self._bucket(level)
        held = sorted({b for b, _, _ in places.values()})
        names = [f"_o{i}" for i in range(len(self._order))]
        left = self._df.filter(bucket.isin(held)).select(
            bucket.alias("b"), *[o.alias(n) for o, n in zip(self._order, names, strict=True)]
        )
        ranked = left.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy(*names)) - 1)
        wanted = F.lit(False)
        for b, place, _ in places.values():
            wanted = wanted | ((F.col("b") == F.lit(b)) & (F.col("r") == place))
        found = {(row["b"], row["r"]): tuple(row[n] for n in names) for row in ranked.filter(wanted).collect()}
        return {rank: found[(b, place)] for rank, (b, place, _) in places.items()}


def hash_index(df: DataFrame, keys: Sequence[str], seed: object) -> RankIndex:
    """Ranks of the seeded permutation of ``keys``; three hex digits of the hash per level."""
    digest = hash_key(seed, keys)
    order = [digest, *[F.col(k) for k in keys]]
    return RankIndex(df, lambda level: F.substring(digest, 1, 3 * level), order, 10)


def integer_index(df: DataFrame, key: str) -> RankIndex:
    """Ranks of a unique integer key in rising order; twelve bits of its range per level."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    bits = 0 if low is None else (int(high) - int(low)).bit_length()
    offset = F.col(key).cast("bigint") - F.lit(0 if low is None else int(low))

    def bucket(level: int) -> Column:
        return F.shiftright(offset, max(0, bits - 12 * level))

    return RankIndex(df, bucket, [F.col(key)], max(1, -(-bits // 12)))


def before(columns: Sequence[Column], values: Sequence[Any], types: Sequence[Any]) -> Column:
    """Rows whose columns come before ``values`` in lexicographic order."""
    result = F.lit(False)
    for column, value, dtype in reversed(list(zip(columns, values, types, strict=True))):
        literal = F.lit(value).cast(dtype)
        result = (column < literal) | ((column == literal) & result)
    return result


def permuted_position(
    df: DataFrame,
    keys: Sequence[str],
    seed: object,
    out: str = "pos",
    within: Sequence[str] = (),
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Adds the 0-based position in the seeded permutation, counted per group of ``within``.

    The hash spreads rows evenly over ``16**digits`` buckets whatever the keys look like, and a
    group of any size over as many; one shuffle by bucket, and one broadcast table of bucket
    offsets. Both are functions of the row values alone, so a recomputed task gives the same
    positions. ``keys`` must be unique; ``within`` is for few groups (splits).
    """
    place = [*within, "_b"]
    marked = df.withColumn("_h", hash_key(seed, keys)).withColumn("_b", F.substring("_h", 1, digits))
    counts = marked.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    # at most 16**digits rows per group, however large the table
    earlier = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("_h", *keys))
    placed = null_safe_join(marked.withColumn("_rank", rank), F.broadcast(offsets), place, "inner")
    return placed.withColumn(out, F.col("_off") + F.col("_rank") - 1).drop(
        "_h", "_b", "_rank", "_off"
    )


def ordered_position(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str = "pos",
    measures: dict[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Adds the 0-based position in ``order`` and running totals of measures before each row.

    ``measures`` maps a result column to the numeric column it sums over all earlier rows. The rows
    are range-partitioned and sorted once; the sorted table is written out, since range bounds come
    from a sample and must not be drawn again. What is added per partition is one row. Pass a narrow
    projection: the whole of ``df`` is written. ``order`` must be total.
    """
    spark = df.sparkSession
    measures = measures or {}
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ordinal = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    staged = materialize(
        df.repartitionByRange(parts, *order_columns)
        .sortWithinPartitions(*order_columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_ord", ordinal),
        "ordered",
    )
    totals = staged.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(source).alias(f"_sum_{name}") for name, source in measures.items()],
    )
    # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_off_{name}")
            for name in measures
        ],
    )
    placed = staged.join(F.broadcast(offsets), "_part").withColumn(
        out, F.col("_off") + F.col("_ord")
    )
    inside = Window.partitionBy("_part").orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    for name, source in measures.items():
        placed = placed.withColumn(
            name, F.coalesce(F.sum(source).over(inside), F.lit(0)) + F.col(f"_off_{name}")
        )
    return placed.drop("_part", "_ord", "_off", *[f"_off_{name}" for name in measures])


def numbered(table: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Positions of a derived table (classes, vocabulary), however many rows it has.

    Such a table ends in an aggregate, whose shuffle serves both the range bounds and the sort.
    """
    return ordered_position(table, order, out)
