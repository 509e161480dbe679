"""Training batches as sharded Parquet."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.position import hash_key

SHARD_ROWS = 1 << 18
MANIFEST = "_manifest"


def write_training_shards(
    batches: DataFrame, path: str, batches_per_shard: int = 1024, split: str = "split"
) -> None:
    """Write rows with ``batch_id`` and ``pos_in_batch`` per split, in batch order.

    Rows go to tasks by split and run of consecutive batches, so a large split spreads over as many
    tasks as it has runs. Unlike a range partitioning this needs no sample, which would compute the
    input twice.
    """
    run = F.floor(F.col("batch_id") / batches_per_shard)
    placed = batches.repartition(F.col(split), run)
    ordered = placed.sortWithinPartitions(split, "batch_id", "pos_in_batch")
    ordered.write.mode("overwrite").partitionBy(split).parquet(path)


def read_training_shards(spark, path: str, split: str) -> DataFrame:
    """The rows of one split; only its folder is read."""
    return spark.read.parquet(path).filter(F.col("split") == split)


def write_ordered_shards(
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    seed: object,
    split: str = "split",
    rows_per_shard: int = SHARD_ROWS,
) -> DataFrame:
    """Write each split in its seeded permutation as numbered shards, and return their manifest.

    The order is that of ``permuted_position``: by the hash of the unique ``keys``. A hash is uniform, so
    its value says in which shard a row lies, and no row is ranked: one exchange by shard number, one
    sort within it, and the place of a row is its shard's first place plus its row in the file.

    The manifest ``(split, shard, file, first_row, n_rows)`` is counted on the committed files and then
    stored beside them, in a folder that Spark's readers pass over: a writer that dies leaves none.
    """
    counts = {r[split]: r["n"] for r in rows.groupBy(split).agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = {name: math.ceil(n / rows_per_shard) for name, n in counts.items()}
    first, number = F.lit(None).cast("int"), 0
    width = F.lit(None).cast("int")
    for name, n in shards.items():
        mine = F.col(split).eqNullSafe(F.lit(name))
        first = F.when(mine, F.lit(number)).otherwise(first)
        width = F.when(mine, F.lit(n)).otherwise(width)
        number += n
    uniform = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") / F.lit(1 << 32)
    placed = rows.withColumn("_h", hash_key(seed, keys))
    dealt = placed.repartitionById(max(number, 1), (first + F.floor(uniform * width)).cast("int"))
    ordered = dealt.sortWithinPartitions(split, "_h", *keys).drop("_h")
    ordered.write.mode("overwrite").partitionBy(split).parquet(path)
    spark = rows.sparkSession
    stored = spark.read.schema(rows.schema).parquet(path)
    files = stored.groupBy(split, F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    # one row per file
    order = Window.partitionBy(split).orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint"), "file")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.select(
        split,
        (F.row_number().over(order) - 1).cast("bigint").alias("shard"),
        "file",
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_row"),
        "n_rows",
    )
    manifest.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return spark.read.schema(manifest.schema).parquet(f"{path}/{MANIFEST}")


def read_ordered_shards(
    spark: SparkSession, path: str, batch_size: int, split: str = "split", name: object = None
) -> DataFrame:
    """The rows of ordered shards with ``pos``, ``batch_id`` and ``pos_in_batch`` in their split.

    With ``name`` only the files of that split are read.
    """
    manifest = spark.read.parquet(f"{path}/{MANIFEST}").select("file", "first_row")
    rows = spark.read.parquet(path)
    if name is not None:
        rows = rows.filter(F.col(split) == F.lit(name))
    columns = rows.columns
    placed = rows.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    pos = (F.col("first_row") + F.col("_row")).alias("pos")
    found = placed.join(manifest, F.col("_file") == F.col("file")).select(*columns, pos)
    return found.withColumns(
        {"batch_id": F.floor(F.col("pos") / batch_size), "pos_in_batch": F.col("pos") % batch_size}
    )
