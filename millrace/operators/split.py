"""Train, validation and test rows; batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.position import (
    RankIndex,
    before,
    hash_index,
    hash_key,
    integer_index,
    ordered_position,
    permuted_position,
)

# The names that may stand for a requested split, best first.
SPLIT_ALIASES = {
    "train": ["training"],
    "val": ["validation", "eval_holdout", "eval", "dev"],
    "validation": ["val", "eval_holdout", "eval", "dev"],
    "test": ["eval_holdout", "eval", "dev", "val", "validation"],
    "eval_holdout": ["val", "validation", "eval", "test"],
}
RATIO_SPLITS = ("train", "val", "test")


def _with_cuts(
    df: DataFrame,
    keys: Sequence[str],
    seed: object,
    cuts: Mapping[str, int],
    index: RankIndex,
    out: str,
) -> DataFrame:
    """Adds the split of a row, by comparing its permutation key with the keys at the cuts."""
    columns = [F.col("_h"), *[F.col(k) for k in keys]]
    types = ["string", *[df.schema[k].dataType for k in keys]]
    at = index.keys_at(sorted({end for end in cuts.values() if 0 < end < index.count}))
    split = F
    for name, end in cuts.items():
        inside = before(columns, at[end], types) if end in at else F.lit(end > 0)
        split = split.when(inside, name)
    # the hash is a column of its own, so that it is computed once per row
    return df.withColumn("_h", hash_key(seed, keys)).withColumn(out, split).drop("_h")


def ratio_sizes(n: int, val_ratio: float = 0.1, test_ratio: float = 0.1) -> dict[str, int]:
    """Rows of each ratio split of ``n`` rows, in the order of the cut."""
    n_val, n_test = int(n * val_ratio), int(n * test_ratio)
    return {"train": n - n_val - n_test, "val": n_val, "test": n_test}


def ratio_split(
    df: DataFrame,
    keys: Sequence[str],
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    seed: object = 42,
    out: str = "split",
    index: RankIndex | None = None,
) -> DataFrame:
    """Adds the split of each row: the seeded permutation cut into train, val and test.

    Sizes are exact: ``int(n * test_ratio)``, ``int(n * val_ratio)``, the rest is train. No row is
    moved: the two cut keys are found by counting and the split is an expression on the row.
    ``keys`` must identify a row. Where ``df`` is costly, give the ``index`` of the table it is made
    from, so that the counting reads that table's keys only.
    """
    index = index or hash_index(df, keys, seed)
    sizes = ratio_sizes(index.count, val_ratio, test_ratio)
    cuts = dict(zip(sizes, accumulate(sizes.values()), strict=True))
    return _with_cuts(df, keys, seed, cuts, index, out)


def ratio_rows(df: DataFrame, keys: Sequence[str], split: str, **options) -> DataFrame:
    """Rows of one ratio split; only the three ratio names exist."""
    if split not in RATIO_SPLITS:
        raise ValueError(f"unknown split {split!r}: a ratio split has only {list(RATIO_SPLITS)}")
    return ratio_split(df, keys, out="_split", **options).filter(F.col("_split") == split).drop(
        "_split"
    )


def permuted_holdout(
    df: DataFrame,
    keys: Sequence[str],
    val_ratio: float,
    seed: object = 42,
    min_one: bool = False,
    out: str = "split",
) -> DataFrame:
    """Adds val to the first ``int(n * val_ratio)`` rows of the permutation, train to the rest.

    ``min_one`` takes at least one row for val.
    """
    index = hash_index(df, keys, seed)
    n_val = int(index.count * val_ratio)
    cuts = {"val": max(1, n_val) if min_one else n_val, "train": index.count}
    return _with_cuts(df, keys, seed, cuts, index, out)


def tail_holdout(df: DataFrame, key: str, val_ratio: float, out: str = "split") -> DataFrame:
    """Adds val to the last ``int(n * val_ratio)`` rows by integer key, train to the rest."""
    index = integer_index(df, key)
    n_val = int(index.count * val_ratio)
    if n_val == 0:
        return df.withColumn(out, F.lit("train"))
    if n_val == index.count:
        return df.withColumn(out, F.lit("val"))
    cut = index.count - n_val
    (first,) = index.keys_at([cut])[cut]
    return df.withColumn(out, F.when(F.col(key) >= F.lit(first), "val").otherwise("train"))


def head_holdout(df: DataFrame, key: str, val_ratio: float, out: str = "split") -> DataFrame:
    """Adds val to the first ``max(1, int(n * val_ratio))`` rows by integer key."""
    index = integer_index(df, key)
    n_val = max(1, int(index.count * val_ratio))
    if n_val >= index.count:
        return df.withColumn(out, F.lit("val"))
    (first,) = index.keys_at([n_val])[n_val]
    return df.withColumn(out, F.when(F.col(key) < F.lit(first), "val").otherwise("train"))


def alias_table(spark) -> DataFrame:
    """``(requested, declared, priority)``: which declared split may stand for a request."""
    rows = []
    for requested, aliases in SPLIT_ALIASES.items():
        rows += [(requested, name, i) for i, name in enumerate([requested, *aliases])]
    return spark.createDataFrame(rows, "requested string, declared string, priority int")


def resolve_split_alias(declared: DataFrame, requests: DataFrame) -> DataFrame:
    """For each request, the declared split that answers it, per dataset.

    ``declared(dataset_id, split_name)`` and ``requests(dataset_id, requested)``. The name itself
    wins, then its aliases in order; ``resolved`` is null when none is declared, and the caller must
    refuse such a request rather than cut by ratio.
    """
    names = F.broadcast(alias_table(declared.sparkSession))
    # names without aliases answer only themselves
    wanted = requests.join(names, "requested", "left").select(
        "dataset_id",
        "requested",
        F.coalesce("declared", "requested").alias("split_name"),
        F.coalesce("priority", F.lit(0)).alias("priority"),
    )
    found = wanted.join(
        declared.select("dataset_id", "split_name", F.lit(True).alias("_is")).distinct(),
        ["dataset_id", "split_name"],
        "left",
    )
    best = F.min(F.when(F.col("_is"), F.struct("priority", "split_name")))
    return found.groupBy("dataset_id", "requested").agg(
        best.getField("split_name").alias("resolved")
    )


def resolve_split_name(declared: Sequence[str], split: str) -> str:
    """The declared split that answers ``split``; an undeclared one is refused."""
    for name in [split, *SPLIT_ALIASES.get(split, [])]:
        if name in declared:
            return name
    raise ValueError(
        f"split {split!r} is not declared; the dataset declares {sorted(declared)} and is not cut "
        "by ratio, since that would mix rows of the declared splits"
    )


def membership_split(
    rows: DataFrame,
    membership: DataFrame,
    split: str,
    keys: Sequence[str] = ("row_index",),
    **ratio_options,
) -> DataFrame:
    """Rows of a declared split with their declared place ``pos``.

    ``membership(split_name, pos, row_index)``; rows it names beyond the table drop out. A dataset
    that declares no split at all is cut by ratio, in which case ``pos`` is the permuted position.
    """
    declared = [r["split_name"] for r in membership.select("split_name").distinct().collect()]
    if not declared:
        chosen = ratio_rows(rows, keys, split, **ratio_options)
        return permuted_position(chosen, keys, ratio_options.get("seed", 42))
    name = resolve_split_name(declared, split)
    listed = membership.filter(F.col("split_name") == name).select("row_index", "pos")
    return rows.join(listed, "row_index", "inner")


def parse_membership(meta: DataFrame) -> DataFrame:
    """``(dataset_id, split_name, pos, row_index)`` from metadata JSON in ``(dataset_id, meta)``.

    Entries that are no integer are skipped and do not count for ``pos``; a split without a list or
    without a text name is left out.
    """
    splits = F.expr("try_variant_get(try_parse_json(meta), '$.splits', 'array<variant>')")
    entry = meta.select("dataset_id", F.explode(splits).alias("s")).select(
        "dataset_id",
        F.expr("case when schema_of_variant(try_variant_get(s, '$.split_name', 'variant')) = 'STRING'"
               " then try_variant_get(s, '$.split_name', 'string') end").alias("split_name"),
        F.expr("try_variant_get(s, '$.member_row_indices', 'array<variant>')").alias("members"),
    )
    ints = F.expr(
        "transform(filter(members, m -> schema_of_variant(m) = 'BIGINT'),"
        " m -> variant_get(m, '$', 'bigint'))"
    )
    kept = entry.filter("split_name is not null and members is not null")
    return kept.select("dataset_id", "split_name", F.posexplode(ints).alias("pos", "row_index"))


def audit_splits(assigned: DataFrame, n_rows: int, key: str = "row_index") -> DataFrame:
    """Counts of rows in two splits, rows in none, and indices beyond the table.

    ``assigned(split_name, row_index)``; one row per finding kind, overlaps per pair of splits.
    """
    listed = assigned.select("split_name", key).distinct()
    inside = listed.filter(F.col(key).between(0, n_rows - 1))
    # a row's splits are a short list: one entry per declared split name
    names = inside.groupBy(key).agg(F.array_sort(F.collect_set("split_name")).alias("names"))
    pairs = F.flatten(
        F.transform(
            "names",
            lambda a: F.transform(
                F.filter("names", lambda b: b > a), lambda b: F.concat_ws("|", a, b)
            ),
        )
    )
    overlap = (
        names.filter(F.size("names") > 1)
        .select(F.explode(pairs).alias("detail"))
        .groupBy("detail")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("overlap").alias("kind"), "detail", "n")
    )
    covered = names.agg(F.count(F.lit(1)).alias("c")).select(
        F.lit("uncovered").alias("kind"), F.lit("").alias("detail"),
        (F.lit(n_rows) - F.col("c")).alias("n"),
    )
    beyond = (
        listed.filter(~F.col(key).between(0, n_rows - 1))
        .groupBy(F.lit("out_of_range").alias("kind"), F.col("split_name").alias("detail"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return overlap.unionByName(covered).unionByName(beyond)


def seeded_shuffle(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 42,
    epoch: int = 0,
    split: str = "train",
    shuffle: bool | None = None,
    out: str = "pos",
) -> DataFrame:
    """Adds the reading order of an epoch; only train is shuffled unless asked otherwise.

    Pass keys only and join the payload late: what is shuffled is then a narrow table.
    """
    if shuffle is None:
        shuffle = split == "train"
    if shuffle:
        return permuted_position(df, keys, f"{seed}:{epoch}", out)
    return ordered_position(df, list(keys), out)


def assign_batches(
    df: DataFrame,
    batch_size: int,
    drop_last: bool = False,
    position: str = "pos",
    total: int | None = None,
) -> DataFrame:
    """Adds ``batch_id`` and ``pos_in_batch`` from a 0-based position.

    ``drop_last`` drops a short last batch; ``total`` saves counting the rows for it.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    batch = F.floor(F.col(position) / batch_size)
    placed = df.withColumn("batch_id", batch).withColumn(
        "pos_in_batch", (F.col(position) % batch_size).cast("int")
    )
    if drop_last:
        n = df.count() if total is None else total
        placed = placed.filter(F.col("batch_id") < n // batch_size)
    return placed


def collect_batches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per batch: each column as the array of its values in batch order."""
    members = F.array_sort(F.collect_list(F.struct("pos_in_batch", *columns)))
    grouped = df.groupBy("batch_id").agg(members.alias("_m"))
    return grouped.select("batch_id", *[F.col(f"_m.{c}").alias(c) for c in columns])


def rebatch(
    batches: DataFrame,
    key: str,
    batch_size: int,
    split: str,
    sequence_length: int | None = None,
    val_ratio: float = 0.1,
    seed: int = 42,
    shuffle: bool = False,
) -> DataFrame:
    """Existing batches to new ones of ``batch_size``.

    ``batches(key, features, labels)`` with one array per batch. Samples are numbered by
    ``(key, place in batch)``; text is hash-tokenized, rows of unequal length are padded to
    ``sequence_length`` or else to the longest row of all batches; train and val are cut by
    permutation with at least one val row.
    """
    from pyspark.sql import types as T

    from millrace.functions.arrays import pad_sequences
    from millrace.functions.text import hash_tokens

    pairs = F.posexplode(F.arrays_zip("features", "labels"))
    samples = batches.select(F.col(key).alias("_k"), pairs.alias("_i", "_s")).select(
        "_k", "_i", F.col("_s.features").alias("features"), F.col("_s.labels").alias("label")
    )
    kind = samples.schema["features"].dataType
    if isinstance(kind, T.StringType):
        samples = samples.withColumn("features", hash_tokens(F.col("features"), sequence_length))
    else:
        low, high = samples.agg(F.min(F.size("features")), F.max(F.size("features"))).first()
        if low != high:
            length = sequence_length or high or 1
            samples = samples.withColumn("features", pad_sequences(F.col("features"), length))
    if split in ("train", "val"):
        samples = permuted_holdout(samples, ["_k", "_i"], val_ratio, seed, min_one=True, out="_s")
        samples = samples.filter(F.col("_s") == split).drop("_s")
        # what is kept stays in permuted order
        placed = permuted_position(samples, ["_k", "_i"], f"{seed}:0" if shuffle else seed)
    elif shuffle:
        placed = permuted_position(samples, ["_k", "_i"], f"{seed}:0")
    else:
        placed = ordered_position(samples, ["_k", "_i"])
    return assign_batches(placed.drop("_k", "_i"), batch_size)


def preview(df: DataFrame, rows: int = 20, order: str = "row_index") -> DataFrame:
    """The first rows; ``rows`` is held within 1..100."""
    return df.orderBy(order).limit(max(1, min(100, rows)))


def preview_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: count, nulls, min, max and mean, in one pass."""
    parts = []
    for c in columns:
        parts += [
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                F.avg(c).alias("mean"),
            )
        ]
    return df.agg(F.array(*parts).alias("s")).select(F.inline("s"))
