"""Text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import lines


def explode_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, line_no, line)``: the non-empty lines of each text."""
    return docs.select(key, F.posexplode(lines(F.col(text))).alias("line_no", "line"))


def scan_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty lines of text files.

    Spark cuts files at line feeds, which lets one file be read by many tasks; the rarer line ends
    are then cut inside each piece.
    """
    pieces = spark.read.option("lineSep", "\n").text(path)
    return pieces.select(F.explode(lines(F.col("value"))).alias("text"))
