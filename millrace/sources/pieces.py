"""One large CSV or JSON file over many tasks, though where a record begins depends on all that stands before.

Spark's text reader gives a file's blocks to many tasks, line by line (CSV) or up to each closing brace
(JSON). A first pass reduces each block to what it does to the state: for CSV whether it turns the inside of
quotes out, for JSON the same and how many braces it leaves open, for either state at its beginning. Summed up
over the blocks before, one row per block, this gives the state where a block begins. A second pass then cuts
each block into records on its own; only the pieces of records that cross a border are put together after a
shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import materialize

_ESCAPED = re.compile(r"\\.", re.DOTALL)
PIECES = "file string, block bigint, at bigint, kind string, text string"


# Bytes of blocks that one task reads, where blocks are made smaller than that.
TASK_BYTES = 64 << 20
# Blocks that one task opens, about: each costs as much as reading some 100 KB.
TASK_BLOCKS = 256


@contextmanager
def block_size(spark: SparkSession, size: int | None, tasks: int | None = None) -> Iterator[None]:
    """Files are read in blocks of ``size`` bytes by what runs inside, by ``tasks`` tasks at most."""
    wanted = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.maxPartitionNum": tasks}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        if value is not None:
            spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _located(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


class _Csv:
    """A line changes the state if it holds an odd number of quotes; lines are parted by line feeds."""

    joint = "\n"

    @staticmethod
    def effects(pieces: DataFrame) -> DataFrame:
        quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
        turns = (F.sum(quotes) % 2 == 1).alias("turns")
        none = F.lit(0).cast("bigint")
        return pieces.groupBy("file", "block").agg(turns, none.alias("outside"), none.alias("inside"))

    @staticmethod
    def step(piece: str, inside: bool, depth: int) -> tuple[bool, int]:
        return inside ^ (piece.count('"') % 2 == 1), 0

    @staticmethod
    def begin(piece: str) -> str:
        return piece

    @staticmethod
    def held(piece: str, ends: bool) -> str:
        return piece.removesuffix("\r") if ends else piece


class _Json:
    """A piece ends in a closing brace; what stands between two objects is dropped."""

    joint = ""

    @staticmethod
    def effects(pieces: DataFrame) -> DataFrame:
        schema = "file string, block bigint, turns boolean, outside bigint, inside bigint"
        return pieces.mapInArrow(_effects(_Json), schema)

    @staticmethod
    def step(piece: str, inside: bool, depth: int) -> tuple[bool, int]:
        plain = _ESCAPED.sub("", piece) if "\\" in piece else piece
        parts = plain.split('"')
        outside = parts[inside::2]
        change = sum(p.count("{") - p.count("}") for p in outside)
        return inside ^ (len(parts) % 2 == 0), depth + change

    @staticmethod
    def begin(piece: str) -> str:
        piece = piece.lstrip("\ufeff \t\r\n,[]")
        # the reader gives no brace behind the end of the array
        return "" if piece == "}" else piece

    @staticmethod
    def held(piece: str, ends: bool) -> str:
        # line breaks stand only between the tokens of an object
        return piece.replace("\n", " ").replace("\r", " ")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, list[str]]]:
    """The values of each stretch of one block, after what all its rows have: file, block and the rest."""
    file, block, values = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_pylist()
    other = pc.not_equal(file.slice(1), file.slice(0, max(len(file) - 1, 0))).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(other | (block[1:] != block[:-1])) + 1
    edges = [0, *cuts.tolist(), len(values)] if values else [0]
    for first, end in zip(edges, edges[1:]):
        shared = (column[first].as_py() for i, column in enumerate(batch.columns) if i != 2)
        yield tuple(shared), values[first:end]


def _cut(rules) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of each block: ``whole``, or the pieces ``tail`` (goes on in the next block) and ``head``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, kind, inside, depth, number = None, [], "whole", False, 0, 0
        rows: list[tuple] = []

        def close(ending: str) -> None:
            nonlocal held, kind, number
            # a piece that neither begins nor ends here goes through the whole block
            name = {"whole": {"end": "whole", "open": "tail"}, "head": {"end": "head", "open": "through"}}[kind][ending]
            rows.append((*key, number, name, rules.held(rules.joint.join(held), ending == "end")))
            held, kind, number = [], "whole", number + 1

        for batch in batches:
            for (file, block, starts_inside, starts_depth), values in _stretches(batch):
                if (file, block) != key:
                    if held:
                        close("open")
                    key, number = (file, block), 0
                    inside, depth = bool(starts_inside), int(starts_depth)
                    kind = "head" if inside or depth else "whole"
                for value in values:
                    if not held and kind == "whole":
                        value = rules.begin(value)
                        if not value:
                            continue
                    held.append(value)
                    inside, depth = rules.step(value, inside, depth)
                    if not inside and depth <= 0:
                        close("end")
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "at", "kind", "text"]
                )
                rows = []
        if held:
            close("open")
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "at", "kind", "text"]
            )

    return run


def _effects(rules):
    """What a block does to the state, whether it begins outside or inside of quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for batch in batches:
            for key, values in _stretches(batch):
                state = found.setdefault(key, [False, 0, True, 0])
                for value in values:
                    state[0], state[1] = rules.step(value, state[0], state[1])
                    state[2], state[3] = rules.step(value, state[2], state[3])
        if found:
            keys, states = zip(*found.items(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([s[0] for s in states], pa.bool_()),
                    pa.array([s[1] for s in states], pa.int64()),
                    pa.array([s[3] for s in states], pa.int64()),
                ],
                names=["file", "block", "turns", "outside", "inside"],
            )

    return run


def _begins(effects: DataFrame) -> DataFrame:
    """``(file, block, starts_inside, starts_depth)`` of the blocks that begin within a record."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.col("turns").cast("int")).over(before), F.lit(0)) % 2 == 1
    known = effects.withColumn("starts_inside", turned)
    change = F.when(F.col("starts_inside"), F.col("inside")).otherwise(F.col("outside"))
    depth = F.coalesce(F.sum("change").over(before), F.lit(0))
    known = known.withColumn("change", change).withColumn("starts_depth", depth)
    return known.filter("starts_inside or starts_depth <> 0").select("file", "block", "starts_inside", "starts_depth")


def records(pieces: DataFrame, rules, block_bytes: int | None = None, tasks: int | None = None) -> DataFrame:
    """``(file, block, at, text)`` of every record of ``pieces(file, block, value)``, in one row each.

    Only the two passes over the files read them in blocks of ``block_bytes``, several to a task if there are
    more than ``tasks``; what is stored between is read as any table.
    """
    spark = pieces.sparkSession
    effects = rules.effects(pieces)
    # at most one row per block of the input
    with block_size(spark, block_bytes, tasks):
        begins = materialize(_begins(effects), "begins")
    started = pieces.join(F.broadcast(begins), ["file", "block"], "left").select(
        "file",
        "block",
        "value",
        F.coalesce("starts_inside", F.lit(False)),
        F.coalesce("starts_depth", F.lit(0).cast("bigint")),
    )
    with block_size(spark, block_bytes, tasks):
        found = materialize(started.mapInArrow(_cut(rules), PIECES), "pieces")
    whole = found.filter("kind = 'whole'").select("file", "block", "at", "text")
    # at most two pieces per block, and one row of its record for each
    order = Window.partitionBy("file").orderBy("block", "at")
    opened = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    crossing = found.filter("kind <> 'whole'").withColumn("record", opened)
    joined = crossing.groupBy("file", "record").agg(
        F.min(F.struct("block", "at")).alias("place"),
        F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("parts"),
    )
    text: Column = F.array_join(F.col("parts.text"), rules.joint)
    return whole.unionByName(joined.select("file", "place.block", "place.at", text.alias("text")))


def _blocks(spark: SparkSession, path: str, block_bytes: int | None, **options) -> tuple[int | None, int | None]:
    """The size of blocks that have a size of their own, and how many tasks read them.

    There are as many tasks as cores, more for large files. Where a task would open more than
    ``TASK_BLOCKS`` blocks, these are made larger, so that their number does not grow with the file.
    """
    if block_bytes is None:
        return None, None
    listed = spark.read.format("binaryFile").options(**options).load(path)
    total = listed.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return max(block_bytes, -(-total // (tasks * TASK_BLOCKS))), tasks


def csv_records(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """The records of CSV files as text. Quotes stand only around fields, and twice within them."""
    lines = _located(spark.read.option("lineSep", "\n").text(path))
    return records(lines, _Csv, *_blocks(spark, path, block_bytes))


def json_records(spark: SparkSession, path: str, files: str, block_bytes: int | None = None) -> DataFrame:
    """The objects of files that hold one JSON array of objects each, one line of text per object."""
    which = {"recursiveFileLookup": True, "pathGlobFilter": files}
    lines = _located(spark.read.option("lineSep", "}").options(**which).text(path))
    # the reader takes the brace away that ends a piece
    closed = lines.withColumn("value", F.concat("value", F.lit("}")))
    return records(closed, _Json, *_blocks(spark, path, block_bytes, **which))
