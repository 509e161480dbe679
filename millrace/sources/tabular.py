"""Parquet, CSV, TSV, JSON and JSON Lines tables."""

from __future__ import annotations

import csv
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_path, materialize
from millrace.sources.pieces import csv_records, json_records

# Separators that are tried, and how much of the file is looked at.
SEPARATORS = ",;\t|"
SNIFF_CHARS = 4096
# All text that a cast to these types takes, within blanks. A cast of any other throws an exception inside, a value
# at a time, and that costs many times what this look at the text does.
_CASTABLE = {
    "bigint": r"[+-]?0*+[0-9]{0,19}(?<=[0-9])",
    "double": r"[+-]?(inf(inity)?|nan|([0-9]++\.?[0-9]*+|\.[0-9]++)(e[+-]?[0-9]++)?[fd]?"
    r"|0x([0-9a-f]++\.?[0-9a-f]*+|\.[0-9a-f]++)p[+-]?[0-9]++[fd]?)",
    "boolean": r"t|true|y|yes|1|f|false|n|no|0",
}
CASTABLE = {kind: rf"(?i)^[\x00-\x20\x7f]*+({text})[\x00-\x20\x7f]*+\z" for kind, text in _CASTABLE.items()}


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_indexed(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with ``row_index``, the 0-based place of each row over all files by name.

    Costs no shuffle of the table: a row's place in its file comes with the scan, and the rows
    before a file are summed over one row per file.
    """
    base = spark.read.parquet(path)
    if len(base.inputFiles()) <= 1:
        return base.select("*", F.col("_metadata.row_index").alias("row_index"))
    rows = base.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_i")
    )
    files = rows.groupBy("_file").agg((F.max("_i") + 1).alias("_n"))
    # one row per file
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.join(F.broadcast(starts), "_file")
    return placed.select(*base.columns, (F.col("_start") + F.col("_i")).alias("row_index"))


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator of a CSV file from its first characters, a comma when unclear."""
    lines: list[str] = []
    size = 0
    for row in spark.read.text(path).limit(SNIFF_CHARS).toLocalIterator():
        lines.append(row["value"])
        size += len(row["value"]) + 1
        if size >= SNIFF_CHARS:
            break
    sample = "\n".join(lines)[:SNIFF_CHARS]
    try:
        return csv.Sniffer().sniff(sample, delimiters=SEPARATORS).delimiter
    except csv.Error:
        return ","


def _plain(schema: T.StructType) -> T.StructType:
    """Inferred types reduced to long, double, boolean and string; dates stay text."""
    plain = T.StructType()
    for field in schema.fields:
        kind: T.DataType = T.StringType()
        if isinstance(field.dataType, T.IntegralType):
            kind = T.LongType()
        elif isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            kind = T.DoubleType()
        elif isinstance(field.dataType, T.BooleanType):
            kind = T.BooleanType()
        plain.add(field.name, kind, True)
    return plain


def scan_csv(
    spark: SparkSession,
    path: str,
    separator: str | None = None,
    schema: T.StructType | None = None,
    sampling: float = 1.0,
    multi_line: bool = True,
) -> DataFrame:
    """A CSV table with header; the separator is sniffed and the types are inferred.

    A quoted field may hold line breaks, and quotes written twice. Give ``schema`` for large data:
    inferring types reads the files once more. With ``multi_line=False``, for data known to have no
    line break inside quotes, one file is read by many tasks.
    """
    separator = separator or sniff_separator(spark, path)
    reader = spark.read.option("header", True).option("sep", separator)
    reader = reader.option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        schema = _plain(
            reader.option("inferSchema", True).option("samplingRatio", sampling).csv(path).schema
        )
    return reader.schema(schema).csv(path)


def _inferred(table: DataFrame) -> T.StructType:
    """The plainest type of each text column that all its values have, as the reader would infer them."""
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}

    def fit(name: str, kind: str) -> Column:
        # the reader takes blanks around a number for a sign of a double
        tight = F.lit(True) if kind == "double" else F.col(name) == F.trim(name)
        held = F.when(tight & F.col(name).rlike(CASTABLE[kind]), F.col(name).try_cast(kind).isNotNull())
        return F.bool_and(F.col(name).isNull() | F.coalesce(held, F.lit(False)))

    fits = table.agg(*[
        fit(c, kind).alias(f"{i}_{kind}")
        for i, c in enumerate(table.columns)
        for kind in kinds
    ], *[F.count(c).alias(f"{i}_n") for i, c in enumerate(table.columns)]).first()
    schema = T.StructType()
    for i, name in enumerate(table.columns):
        kind = next((k for k in kinds if fits[f"{i}_{k}"] and fits[f"{i}_n"]), None)
        schema.add(name, kinds.get(kind, T.StringType()))
    return schema


def scan_large_csv(
    spark: SparkSession,
    path: str,
    separator: str | None = None,
    schema: T.StructType | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """A CSV table with header as ``scan_csv`` gives it, each file read by many tasks.

    For few large files: the records are cut and stored once, so a file is read twice and written once.
    Every field that holds a quote, a separator or a line break must be quoted. ``block_bytes`` is the
    size of a block, by default the session's; a task reads several blocks if they are small.
    """
    separator = separator or sniff_separator(spark, path)
    rows = materialize(csv_records(spark, path, block_bytes), "records")
    options = {"sep": separator, "escape": '"'}
    head = rows.filter((F.col("block") == 0) & (F.col("at") == 0))
    first = head.agg(F.min(F.struct("file", "text"))).first()[0]
    if first is None:
        return spark.createDataFrame([], schema or T.StructType())
    names = next(csv.reader([first["text"].removeprefix("\ufeff")], delimiter=separator))
    plain = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    body = rows.filter(((F.col("block") > 0) | (F.col("at") > 0)) & (F.trim("text") != ""))
    fields = body.select(F.from_csv("text", plain, options).alias("r")).select("r.*")
    kinds = schema or _inferred(fields)
    return fields.select(*[
        F.col(f"`{name}`").cast(field.dataType).alias(field.name)
        for name, field in zip(names, kinds.fields, strict=True)
    ])


def scan_large_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    files: str | None = None,
    block_bytes: int | None = None,
) -> DataFrame:
    """Files that each hold one JSON array of objects as ``scan_json`` reads them, each by many tasks.

    The objects are stored once as JSON Lines, from which Spark infers the schema and reads.
    """
    out = fresh_path(spark, "objects")
    json_records(spark, path, files or JSON_FILES, block_bytes).select("text").write.text(out)
    return scan_jsonl(spark, out, schema)


def scan_tsv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    return scan_csv(spark, path, "\t", schema, multi_line=multi_line)


# File names that end in .json, but for meta.json, as a file pattern: what differs at each letter.
JSON_FILES = "{[^m]*,m,me,met,m[^e]*,me[^t]*,met[^a]*,meta[^.]*,meta.?*}.json"


def scan_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, files: str = JSON_FILES
) -> DataFrame:
    """Files that each hold one JSON array of records; ``meta.json`` is metadata, not data.

    ``files`` says which files of a folder are read, also when the schema is inferred from them.
    """
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", files)
    return (reader if schema is None else reader.schema(schema)).json(path)


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def project_layout(table: DataFrame, layout: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """The columns of a layout, each from its source column or the one of its own name."""
    columns = []
    for name, spec in layout.items():
        source = spec.get("column") or name
        if not isinstance(source, str) or source not in table.columns:
            raise ValueError(f"column {name!r}: the table has no source column {source!r}")
        columns.append(F.col(source).alias(name))
    return table.select(*columns)


def scan_tabular(
    spark: SparkSession, path: str, layout: Mapping[str, Mapping[str, object]]
) -> DataFrame:
    """A CSV or Parquet table as the columns of a layout; only those are read from Parquet.

    A folder of another name stands for the first CSV or Parquet file in it by name.
    """
    if not path.rstrip("/").endswith((".csv", ".parquet")):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.{csv,parquet}").load(path)
        path = listed.agg(F.min("path")).first()[0]
        if path is None:
            raise ValueError("the folder holds no CSV or Parquet file")
    table = scan_csv(spark, path, ",") if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    return project_layout(table, layout)
