"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only what the operators rely on; a cluster sets sizes and memory itself.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: str = "*", name: str = "millrace", **extra: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in {**SETTINGS, "spark.driver.memory": "12g", **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read and write.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a read instead of the whole upstream plan, and gives
    Catalyst the true size of the table: whether a later join may broadcast it is then decided on
    measured bytes.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table that is stored in fewer pieces than there are cores, before costly row work.

    A table of many pieces is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
