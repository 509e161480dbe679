"""Stream output as tables that survive a restart.

Every micro-batch writes its own folder and overwrites it when it is run again, so a batch that is
repeated after a failure leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.session import fresh_path

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """All batches of a table, or those before one; empty when nothing has been written."""
    has_any = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = has_any.option("pathGlobFilter", "*.parquet").load(path).select("path").limit(1).count()
    except Exception as error:  # the folder appears with the first batch
        if "PATH_NOT_FOUND" not in str(error):
            raise
        found = 0
    if not found:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    table = rows if "batch" in rows.columns else rows.withColumn("batch", F.lit(0))
    return table if before is None else table.filter(F.col("batch") < before)


def newest_batch(spark: SparkSession, path: str, schema, before: int) -> DataFrame:
    """What the last batch before ``before`` wrote: for tables that every batch writes whole."""
    rows = read_batches(spark, path, schema, before)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.filter(F.col("batch") == F.lit(last)).drop("batch")


def latest_rows(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key from its last batch."""
    values = [c for c in table.columns if c not in keys and c != "batch"]
    last = F.max_by(F.struct(*values), "batch").alias("s")
    return table.groupBy(*keys).agg(last).select(*keys, "s.*")


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    mode: str = "append",
    **trigger,
) -> StreamingQuery:
    """Start a stream whose micro-batches go to ``handle``; by default it reads what is there.

    Its state lies in RocksDB, which the operators with timers need and which holds more state than
    fits in memory. The setting is the query's alone.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint or fresh_path(spark, "stream"))
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def run_to_table(
    stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None
) -> None:
    """Run a stream over what is there and store each micro-batch."""
    query = start(stream, lambda rows, batch: write_batch(rows, path, batch), checkpoint, mode)
    query.awaitTermination()
