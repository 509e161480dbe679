"""JSON Lines event logs with the byte offset of each line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.records import is_json_object
from millrace.session import materialize
from millrace.sources.growing import lines_since

BYTE_ORDER_MARK = "\ufeff"


def raw_lines(reader, path: str) -> DataFrame:
    """Lines with the file, the piece of the file and the file size, by ``spark.read`` or
    ``spark.readStream``."""
    text = reader.format("text").option("lineSep", "\n").option("recursiveFileLookup", True)
    return _located(text.load(path))


def _located(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
        F.col("value").alias("line"),
    )


def offset_lines(raw: DataFrame) -> DataFrame:
    """``(file, offset, line, end)`` of every complete line of a scan; ``end`` is behind its feed.

    A file is read by many tasks. Inside one piece a running sum of line lengths gives the offset;
    the pieces before it are summed over one row per piece. A last line without its line feed is
    still being written and held back.
    """
    staged = materialize(
        raw.withColumn("_ord", F.monotonically_increasing_id()).withColumn(
            "_len", (F.octet_length("line") + 1).cast("bigint")
        ),
        "loglines",
    )
    pieces = staged.groupBy("file", "_block").agg(
        F.sum("_len").alias("_bytes"), F.max("_size").alias("_size")
    )
    whole = Window.partitionBy("file")
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Spark's reader drops a byte order mark; the lines are then three bytes short of the file, not
    # counting the one line feed that may be missing at its end
    short = F.col("_size") - F.sum("_bytes").over(whole)
    starts = pieces.select(
        "file",
        "_block",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_start"),
        F.when(short >= 2, 3).otherwise(0).alias("_mark"),
    )
    inside = (
        Window.partitionBy("file", "_block").orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = staged.withColumn("_before", F.coalesce(F.sum("_len").over(inside), F.lit(0))).join(
        starts, ["file", "_block"]
    )
    place = F.col("_start") + F.col("_before")
    end = place + F.col("_mark") + F.col("_len")
    offset = F.when(place > 0, place + F.col("_mark")).otherwise(place)
    return placed.filter(end <= F.col("_size")).select("file", offset.alias("offset"), "line", end.alias("end"))


def json_lines(lines: DataFrame) -> DataFrame:
    """The lines that hold exactly one JSON object, cleaned of the mark and carriage returns."""
    text = F.when(
        F.col("offset") == 0, F.regexp_replace("line", "^" + BYTE_ORDER_MARK, "")
    ).otherwise(F.col("line"))
    clean = lines.withColumn("line", F.regexp_replace(text, r"\r+$", ""))
    return clean.filter((F.trim("line") != "") & is_json_object(F.col("line")))


def log_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, size)`` of the log files as they are listed; their contents aren't read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("size"))


def new_lines(spark: SparkSession, path: str, seen: DataFrame) -> DataFrame:
    """``(file, offset, line, end)`` of the lines that have ended behind ``seen(file, size)``.

    A line that was still being written when its file had the size seen ends behind it, and is
    returned now. Only what lies behind is read, in byte ranges; the sizes, one number per file, pass
    through the driver, which lists the files anyway.
    """
    known = seen.groupBy("file").agg(F.max("size").alias("size")).collect()
    return lines_since(spark, path, {r["file"]: r["size"] for r in known})


def scan_events(
    spark: SparkSession, path: str, replay: bool = True, seen: DataFrame | None = None
) -> DataFrame:
    """``(file, offset, line)`` of the events in a log.

    With ``seen(file, size)`` only lines that ended behind the sizes already seen are returned;
    without ``replay`` and ``seen`` reading starts at the end, so there is nothing yet.
    """
    if seen is not None:
        return json_lines(new_lines(spark, path, seen)).drop("end")
    events = json_lines(offset_lines(raw_lines(spark.read, path))).drop("end")
    return events if replay else events.limit(0)
