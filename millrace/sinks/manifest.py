"""Files with their checksums, and preview images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.records import MAX_IMAGE_TEXT, checksum, image_bytes, image_refusal, sniff_image
from millrace.functions.text import safe_component
from millrace.operators.joins import verify_checksums
from millrace.session import fresh_path


def manifest_rows(files: DataFrame, file: str = "file", content: str = "content") -> DataFrame:
    """``(file, size_bytes, checksum)`` of file contents."""
    rest = ["modified"] if "modified" in files.columns else []
    return files.select(
        F.col(file).alias("file"),
        F.octet_length(content).cast("bigint").alias("size_bytes"),
        checksum(F.col(content).cast("binary")).alias("checksum"),
        *rest,
    )


def scan_manifest(spark, root: str) -> DataFrame:
    """The manifest of all files below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return manifest_rows(
        files.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), "content")
    )


def write_manifest(files: DataFrame, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Store contents with their manifest after every checksum has been verified.

    The contents go to a staging table first; checksums are taken of what was stored. Only if each
    expected file is there and right does the manifest, which makes the files visible, get written.
    """
    spark = files.sparkSession
    staged = fresh_path(spark, "staged")
    files.write.parquet(staged)
    stored = manifest_rows(spark.read.parquet(staged))
    if expected is not None:
        bad = verify_checksums(expected, stored).filter("status != 'ok'").limit(5).collect()
        if bad:
            raise ValueError(f"checksums do not hold: {[(r['file'], r['status']) for r in bad]}")
    stored.withColumn("stored_in", F.lit(staged)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def extract_preview_media(
    samples: DataFrame,
    dataset_id: str,
    column: str,
    index: str = "row_index",
    most: int | None = MAX_IMAGE_TEXT,
) -> DataFrame:
    """Samples with image cells replaced by a file name, the image in ``content``.

    Other cells stay as they are and have null ``content``; ``refused`` says why: ``not base64``, ``too
    long`` (more than ``most`` characters; None sets no limit), or ``no image`` for bytes of another kind.
    """
    raw = image_bytes(F.col(column), most)
    kind = sniff_image(raw)
    refused = F.coalesce(image_refusal(F.col(column), most), F.when(kind.isNull(), "no image"))
    safe = [safe_component(F.lit(part)) for part in (dataset_id, column)]
    name = F.concat(
        safe[0], F.lit("-sample"), F.col(index).cast("string"), F.lit("-"), safe[1], F.lit("."), kind
    )
    return samples.withColumns(
        {
            column: F.when(kind.isNotNull(), name).otherwise(F.col(column)),
            "content": F.when(kind.isNotNull(), raw),
            "refused": refused,
        }
    )
