"""Lookups and matches that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# A key with more than 1/HOT_SHARE of the weight counts as hot; there are fewer than HOT_SHARE.
HOT_SHARE = 200
SALTS = 64


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str | None = None,
    how: str = "left",
    stored: bool = False,
    by: str | None = None,
) -> DataFrame:
    """Join ``facts`` to a table with one row per key; null matches null.

    The table is stored first (``stored`` says that it is already cheap to read), so Catalyst decides
    on measured bytes whether it is broadcast. ``weight`` names the table's column with each key's
    number of fact rows; it does not appear in the result. With it, keys of more than
    ``1 / HOT_SHARE`` of all rows, of which there are fewer than ``HOT_SHARE``, are broadcast, their
    rows spread over ``SALTS`` shuffle keys, and all other keys meet as usual. Without it, skewed
    partitions are left to adaptive execution. ``by`` is a join hint for the other keys, where the join
    shall be the same at every size.
    """
    keys = list(on)
    if not stored:
        table = materialize(table, "lookup")

    def hinted(side: DataFrame) -> DataFrame:
        return side if by is None else side.hint(by)

    if weight is None:
        return null_safe_join(facts, hinted(table), keys, how)
    values = [c for c in table.columns if c not in keys and c != weight]
    total, top = table.agg(F.sum(weight), F.max(weight)).first()
    if not top or top * HOT_SHARE <= total:
        return null_safe_join(facts, hinted(table.drop(weight)), keys, how)
    hot_row = F.col(weight) * HOT_SHARE > total
    renamed = [F.col(c).alias(f"_hot_{c}") for c in values]
    hot = table.filter(hot_row).select(*keys, *renamed, F.lit(True).alias("_hot"))
    marked = null_safe_join(facts, F.broadcast(hot), keys, "left")
    # a hash of the row, not a counter: a recomputed task must send its rows to the same place
    spread = F.when(
        F.col("_hot"), F.pmod(F.xxhash64(*_hashable(facts)), F.lit(SALTS)) + 1
    ).otherwise(0)
    marked = marked.withColumn("_salt", spread.cast("int"))
    cold = table.filter(~hot_row).drop(weight).withColumn("_salt", F.lit(0)).withColumn(
        "_cold", F.lit(True)
    )
    joined = null_safe_join(marked, hinted(cold), [*keys, "_salt"], "left")
    if how == "inner":
        joined = joined.filter(F.col("_hot") | F.col("_cold"))
    picked = [
        F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values
    ]
    return joined.select(*facts.columns, *picked)


def _hashable(df: DataFrame) -> list[Column]:
    skip = ("map<", "variant")
    return [
        df[f.name] for f in df.schema.fields
        if not any(word in f.dataType.simpleString() for word in skip)
    ]


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str
) -> DataFrame:
    """Equi-join in which null matches null; the keys appear once."""
    renamed = right.select(*[
        F.col(c).alias(f"_key_{c}") if c in keys else F.col(c) for c in right.columns
    ])
    condition: Column | None = None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"_key_{key}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_key_{k}" for k in keys])


def rows_at(rows: DataFrame, membership: DataFrame, key: str = "row_index") -> DataFrame:
    """The rows named by ``membership``, with its columns (order position) attached."""
    return rows.join(membership, key, "inner")


def pending_uploads(offered: DataFrame, committed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Offered artifacts that no earlier attempt has committed."""
    return offered.join(committed.select(*on), list(on), "left_anti")


def normalize_by_descriptor(
    values: DataFrame, descriptors: DataFrame, column: str = "name", value: str = "v"
) -> DataFrame:
    """Values less the mean and over the spread that their column's descriptor names.

    ``descriptors(name, mean, std)`` has one row per column; values of columns without one stay.
    """
    found = lookup_join(values, descriptors.select(F.col("name").alias(column), "mean", "std"), [column])
    plain = F.col(value).cast("double")
    scaled = F.when(F.col("mean").isNull(), plain).otherwise((plain - F.col("mean")) / F.col("std"))
    return found.withColumn(value, scaled).drop("mean", "std")


def verify_checksums(expected: DataFrame, actual: DataFrame, on: str = "file") -> DataFrame:
    """Compare ``checksum`` per file: ``ok``, ``mismatch``, ``missing`` or ``unexpected``.

    A file without an expected checksum can't be verified and counts as ``unverified``.
    """
    want = expected.select(on, F.regexp_replace("checksum", "^sha256:", "").alias("expected"),
                           F.lit(True).alias("_want"))
    have = actual.select(on, F.col("checksum").alias("actual"), F.lit(True).alias("_have"))
    status = (
        F.when(F.col("_have").isNull(), "missing")
        .when(F.col("_want").isNull(), "unexpected")
        .when(F.col("expected").isNull(), "unverified")
        .when(F.col("expected") == F.col("actual"), "ok")
        .otherwise("mismatch")
    )
    return want.join(have, on, "full_outer").select(on, "expected", "actual", status.alias("status"))
