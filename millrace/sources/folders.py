"""Media folders as path tables: classes, splits, pairs. A file is opened only where its content is used.

Folders are listed by tasks, all those of one depth at a time, and what they hold is stored: the driver never
holds the names of the files.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.catalog import distinct_classes
from millrace.operators.joins import lookup_join
from millrace.session import fresh_path
from millrace.sources.growing import _open

# Folder names that mean a split, and media file extensions.
SPLIT_FOLDERS = ("train", "val", "validation", "test", "dev")
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif", ".webp")
AUDIO_EXTENSIONS = (".wav", ".mp3", ".flac", ".ogg", ".aac", ".wma", ".m4a")
# Folders that may stand for a requested split, best first.
FOLDER_ALIASES = {
    "val": ["validation", "dev"],
    "validation": ["val"],
    "test": ["dev"],
}


# Names that leave a listing task at a time, rows of a stored file of names, and bytes of contents read at a time.
NAMES_OUT = 10_000
NAMES_STORED = 200_000
CONTENT_BYTES = 8 << 20

ENTRIES = "path string, relative string, size_bytes bigint, is_folder boolean"


def _is_listed(name: str, is_folder: bool) -> bool:
    """Whether Spark's own readers list a file or folder of this name."""
    if is_folder and name.startswith(("_metadata", "_common_metadata")):
        return True
    return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))


def _inside(uri: str, relative: str) -> Iterator[tuple[str, str, int | None, bool]]:
    """What lies directly in a folder, one entry at a time where the file system allows it. Empty files are left out."""
    system, path, prefix = _open(uri)
    head = f"{relative}/" if relative else ""
    if not isinstance(system, fs.LocalFileSystem):
        for info in system.get_file_info(fs.FileSelector(path)):
            is_folder = info.type == fs.FileType.Directory
            if _is_listed(info.base_name, is_folder) and (is_folder or info.size):
                yield prefix + info.path, head + info.base_name, None if is_folder else info.size, is_folder
        return
    with os.scandir(path) as entries:
        for entry in entries:
            try:
                is_folder = entry.is_dir()
                if not _is_listed(entry.name, is_folder):
                    continue
                size = None if is_folder else entry.stat().st_size
            except FileNotFoundError:  # gone since, or a link to nothing
                continue
            if is_folder or size:
                yield f"{prefix}{path.rstrip('/')}/{entry.name}", head + entry.name, size, is_folder


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.bool_()]
    for batch in batches:
        for uri, relative in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            found = _inside(uri, relative)
            while rows := list(islice(found, NAMES_OUT)):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "relative", "size_bytes", "is_folder"])


@F.pandas_udf(T.BinaryType())
def _content(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The bytes of files, a few megabytes of them at a time."""
    for part in paths:
        held, size = [], 0
        for uri in part:
            system, path, _ = _open(uri)
            with system.open_input_stream(path) as file:
                held.append(file.read())
            size += len(held[-1])
            if size >= CONTENT_BYTES:
                yield pd.Series(held, dtype=object)
                held, size = [], 0
        if held:
            yield pd.Series(held, dtype=object)


def _is_walked(spark: SparkSession, root: str) -> bool:
    """Whether ``root`` is a folder that tasks can list themselves."""
    if root.startswith("/") and not spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        return False
    try:
        system, path, _ = _open(root)
        return system.get_file_info(path).type == fs.FileType.Directory
    except (ValueError, OSError):  # a relative path, or a file system that pyarrow has no access to
        return False


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, relative, size_bytes, content)`` of all files below ``root``.

    ``content`` is read only by plans that use it. Names are listed by tasks, one per folder, when this is
    called, and stored. A root that ``pyarrow.fs`` can't list, or that is a file or a pattern, is listed by
    Spark's reader, on the driver.
    """
    if not _is_walked(spark, root):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        relative = F.regexp_replace(F.substring_index("path", root.rstrip("/") + "/", -1), "^/+", "")
        return files.select("path", relative.alias("relative"), F.col("length").alias("size_bytes"), "content")
    store, depth = fresh_path(spark, "listing"), 0
    level = spark.createDataFrame([(root, "")], "path string, relative string")
    while level.limit(1).count():
        place = f"{store}/depth={depth}"
        level.mapInArrow(_entries, ENTRIES).write.option("maxRecordsPerFile", NAMES_STORED).parquet(place)
        found = spark.read.schema(ENTRIES).parquet(place).filter("is_folder").select("path", "relative")
        level, depth = found.repartition(spark.sparkContext.defaultParallelism), depth + 1
    files = spark.read.schema(ENTRIES).option("basePath", store).parquet(store).filter("not is_folder")
    return files.select("path", "relative", "size_bytes", _content("path").alias("content"))


def suffix(name: Column) -> Column:
    """Extension with its dot; a name that only starts with a dot has none."""
    return F.regexp_extract(name, r"[^/.][^/]*(\.[^./]+)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^/])\.[^./]+$", "")


def class_folder_files(
    files: DataFrame,
    extensions: Sequence[str] = IMAGE_EXTENSIONS,
    any_case: bool = True,
    hidden: Sequence[str] = (".",),
    prefix: str = "",
) -> DataFrame:
    """Adds ``class_name`` and ``label`` to the media files directly inside class folders.

    ``files`` has ``relative``; classes are the folders below ``prefix`` that do not start with a
    hidden mark, numbered in sorted order, also those without a matching file.
    """
    inner = F.col("relative")
    if prefix:
        head = prefix.rstrip("/") + "/"
        files = files.filter(inner.startswith(head))
        inner = inner.substr(F.lit(len(head) + 1), F.length("relative"))
    parts = F.split(inner, "/")
    placed = files.withColumn("class_name", F.get(parts, F.lit(0))).withColumn(
        "file_name", F.element_at(parts, -1)
    ).withColumn("_depth", F.size(parts))
    shown = F.lit(True)
    for mark in hidden:
        shown = shown & ~F.col("class_name").startswith(mark)
    placed = placed.filter((F.col("_depth") >= 2) & shown)
    classes = distinct_classes(placed, "class_name").withColumnRenamed("class_index", "label")
    extension = suffix(F.col("file_name"))
    wanted = (F.lower(extension) if any_case else extension).isin(*extensions)
    media = placed.filter((F.col("_depth") == 2) & wanted).drop("_depth")
    return lookup_join(media, classes, ["class_name"], how="inner", stored=True)


def scan_image_folder(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    return class_folder_files(list_files(spark, root), IMAGE_EXTENSIONS, prefix=prefix)


def scan_audio_folder(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    return class_folder_files(list_files(spark, root), AUDIO_EXTENSIONS, prefix=prefix)


def scan_declared_folder(
    spark: SparkSession, root: str, folder: str, extensions: Sequence[str], kind: str
) -> DataFrame:
    """Class folders of a declared layout: extensions match exactly; no file is an error."""
    hidden = ("_",) if kind == "audio" else ()
    files = class_folder_files(
        list_files(spark, root), extensions, any_case=False, hidden=hidden, prefix=folder
    )
    if files.select("label").limit(1).count() == 0:
        raise ValueError(f"no {kind} files in class folders under {root}/{folder}")
    return files


def sort_files(files: DataFrame) -> DataFrame:
    """By class, then file name, in byte order."""
    return files.orderBy("class_name", "file_name")


def pair_by_stem(
    images: DataFrame,
    masks: DataFrame,
    image_extensions: Sequence[str],
    mask_extensions: Sequence[str],
) -> DataFrame:
    """``(stem, image, mask)`` of images and masks of one base name.

    Both tables have ``file_name``. Of several masks the extension declared first wins; an image
    without mask drops out.
    """
    rank = F.array_position(F.lit(list(mask_extensions)), suffix(F.col("file_name")))
    best = (
        masks.withColumn("_rank", rank)
        .filter("_rank > 0")
        .groupBy(stem(F.col("file_name")).alias("stem"))
        .agg(F.min_by("file_name", "_rank").alias("mask"))
    )
    named = images.filter(suffix(F.col("file_name")).isin(*image_extensions)).select(
        stem(F.col("file_name")).alias("stem"), F.col("file_name").alias("image")
    )
    # both sides grow with the files: never a broadcast, however few bytes the names are taken for
    return named.join(best.hint("merge"), "stem")


def scan_image_mask_pairs(
    spark: SparkSession,
    root: str,
    image_dir: str,
    mask_dir: str,
    image_extensions: Sequence[str],
    mask_extensions: Sequence[str],
) -> DataFrame:
    files = list_files(spark, root)

    def inside(folder: str) -> DataFrame:
        head = folder.strip("/") + "/"
        name = F.col("relative").substr(F.lit(len(head) + 1), F.length("relative"))
        named = files.filter(F.col("relative").startswith(head)).select(
            "path", name.alias("file_name")
        )
        return named.filter(~F.contains(F.col("file_name"), F.lit("/")))

    pairs = pair_by_stem(inside(image_dir), inside(mask_dir), image_extensions, mask_extensions)
    if pairs.limit(1).count() == 0:
        raise ValueError(f"no paired image and mask under {root}")
    return pairs


def discover_layout(paths: DataFrame, root: str = "root", relative: str = "relative") -> DataFrame:
    """``(root, has_explicit_splits, splits, class_names)`` per dataset root of a path table.

    A root with split folders that hold class folders is split. Otherwise its classes are the
    folders, other than split names, that directly hold a visible file.
    """
    parts = F.split(F.col(relative), "/")
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    depth = F.size(parts)
    visible = ~first.startswith(".") & (depth >= 2)
    is_split = F.lower(first).isin(*SPLIT_FOLDERS)
    in_class = visible & is_split & (depth >= 3) & ~second.startswith(".")
    plain_class = visible & ~is_split & (depth == 2) & ~second.startswith(".")
    # names of folders, not of files: bounded by the folders of one dataset
    found = paths.groupBy(root).agg(
        F.array_sort(F.collect_set(F.when(in_class, first))).alias("splits"),
        F.array_sort(F.collect_set(F.when(in_class, second))).alias("split_classes"),
        F.array_sort(F.collect_set(F.when(plain_class, first))).alias("plain_classes"),
    )
    split = F.size("splits") > 0
    return found.select(
        root,
        split.alias("has_explicit_splits"),
        "splits",
        F.when(split, F.col("split_classes")).otherwise(F.col("plain_classes")).alias("class_names"),
    )


def filter_split_files(files: DataFrame, split: str, folder: str = "folder", root: str = "root") -> DataFrame:
    """The files of the folder that answers ``split``, per dataset root.

    The folder itself, else its aliases, else ``train``; a root with none of them fails the job.
    """
    names = [split, *FOLDER_ALIASES.get(split, []), "train"]
    rank = F.array_position(F.lit(list(dict.fromkeys(names))), F.col(folder))
    best = files.groupBy(root).agg(
        F.min(F.when(rank > 0, F.struct(rank.alias("rank"), F.col(folder).alias("name")))).alias("_best")
    )
    chosen = F.when(F.col("_best").isNotNull(), F.col("_best.name")).otherwise(
        F.raise_error(F.concat(F.lit(f"no folder answers split {split!r} in "), F.col(root)))
    )
    wanted = best.select(root, chosen.alias(folder))
    return lookup_join(files, wanted, [root, folder], how="inner")
