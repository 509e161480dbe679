"""Readers of declared formats by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.encode import lm_sequences
from millrace.sources.arrays import scan_npz
from millrace.sources.folders import scan_declared_folder, scan_image_mask_pairs
from millrace.sources.tabular import scan_tabular
from millrace.sources.text import scan_text_lines

Layout = Mapping[str, Mapping[str, object]]
Reader = Callable[[SparkSession, str, Layout, str], DataFrame]


def _text(spark: SparkSession, path: str, layout: Layout, split: str) -> DataFrame:
    spec = layout.get("text")
    if spec is None or not isinstance(spec.get("file"), str):
        raise ValueError("text format: the layout needs text.file")
    file = inside(path, spec["file"])
    if spec.get("self_supervised") != "next_token":
        return scan_text_lines(spark, file)
    corpus = spark.read.option("lineSep", "\n").text(file).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    from millrace.session import materialize

    windows = lm_sequences(
        materialize(corpus, "corpus"), "value", ["file", "block", "at"],
        int(spec.get("sequence_length", 128)), spec.get("vocab_size"),
    )
    return windows.select("window_id", F.col("x").alias("text"), F.col("y").alias("target"))


def _image_mask(spark: SparkSession, path: str, layout: Layout, split: str) -> DataFrame:
    mask = next((name for name in layout if name != "image"), None)
    if mask is None:
        raise ValueError("image_mask_folder: the layout needs a mask column")
    image, other = layout["image"], layout[mask]
    pairs = scan_image_mask_pairs(
        spark, path, str(image["dir"]), str(other["dir"]), image["ext"], other["ext"]
    )
    return pairs.withColumnRenamed("mask", mask)


READERS: dict[str, Reader] = {
    "array": lambda spark, path, layout, split: scan_npz(spark, path, layout, split),
    "audio_folder": lambda spark, path, layout, split: scan_declared_folder(
        spark, path, str(layout["audio"].get("dir", "")), layout["audio"]["ext"], "audio"
    ),
    "image_folder": lambda spark, path, layout, split: scan_declared_folder(
        spark, path, str(layout["image"]["dir"]), layout["image"]["ext"], "image"
    ),
    "image_mask_folder": _image_mask,
    "tabular": lambda spark, path, layout, split: scan_tabular(spark, path, layout),
    "text": _text,
}


def inside(base: str, relative: str) -> str:
    """A path below ``base``; absolute paths and parent steps are refused."""
    steps = relative.replace("\\", "/").split("/")
    if not relative or steps[0] == "" or ".." in steps:
        raise ValueError(f"path leaves the dataset folder: {relative!r}")
    return f"{base.rstrip('/')}/{'/'.join(s for s in steps if s not in ('', '.'))}"


def reader_for(format_name: str) -> Reader:
    if format_name not in READERS:
        raise ValueError(f"unknown format {format_name!r}; known formats: {sorted(READERS)}")
    return READERS[format_name]
