"""Growing line files as a data source: offsets per file, byte ranges per task.

``spark.read`` and ``spark.readStream`` with format ``growing_lines`` give ``(file, offset, line, end)`` of
complete lines. A stream's offset is the end of the last complete line of each file, so what a file has
gained is read and nothing before it, after a restart too; a line that is still being written waits. What a
file has gained is cut into byte ranges, which are dealt to tasks by their bytes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
SCHEMA = "file string, offset bigint, line string, end bigint"
# Bytes of a task, of a look at the end of a file, and of a first look behind the end of a range.
RANGE_BYTES = 64 << 20
LOOK_BYTES = 1 << 16
BEHIND_BYTES = 1 << 12
# Bytes of lines in one batch on their way to Spark.
BATCH_BYTES = 4 << 20


def _open(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path on it, and what stands before that in its full name."""
    if found := re.match(r"(?:file:)?(/.*)", uri):
        return fs.LocalFileSystem(), re.sub("^/+", "/", found[1]), "file:"
    system, path = fs.FileSystem.from_uri(uri)
    return system, path, uri[: uri.index(path)] if path in uri else ""


class ByteRange(InputPartition):
    """The lines of ``file`` that begin in ``[start, stop)``; the last of them ends at ``end`` at most."""

    def __init__(self, file: str, start: int, stop: int, end: int, first: bool):
        self.file, self.start, self.stop, self.end, self.first = file, start, stop, end, first


class ByteRanges(InputPartition):
    """The ranges of one task."""

    def __init__(self, ranges: list[ByteRange]):
        self.ranges = ranges


def last_line_end(system: fs.FileSystem, path: str, size: int, known: int = 0) -> int:
    """The place behind the last line feed of a file before ``size``, ``known`` if none is behind it."""
    with system.open_input_file(path) as file:
        at = size
        while at > known:
            start = max(known, at - LOOK_BYTES)
            feed = file.read_at(at - start, start).rfind(b"\n")
            if feed >= 0:
                return start + feed + 1
            at = start
    return known


def byte_ranges(before: dict[str, int], now: dict[str, int], size: int) -> list[ByteRange]:
    """What files have gained, in ranges of about ``size`` bytes. A file that has become shorter counts as new."""
    ranges = []
    for file, end in sorted(now.items()):
        begin = before.get(file, 0)
        begin = 0 if begin > end else begin
        for start in range(begin, end, size):
            ranges.append(ByteRange(file, start, min(start + size, end), end, start == begin))
    return ranges


def dealt(ranges: list[ByteRange], tasks: int) -> list[ByteRanges]:
    """Ranges in their order to about ``tasks`` tasks of the same bytes, to more if these would be above ``RANGE_BYTES``."""
    share = min(RANGE_BYTES, -(-sum(r.stop - r.start for r in ranges) // tasks))
    parts: list[ByteRanges] = []
    held = share
    for part in ranges:
        if held >= share:
            parts.append(ByteRanges([]))
            held = 0
        parts[-1].ranges.append(part)
        held += part.stop - part.start
    return parts


def lines_of_all(ranges: list[ByteRange]) -> Iterator[pa.RecordBatch]:
    """The lines of ranges, a few megabytes at a time however small the ranges are."""
    held, size = [], 0
    for part in ranges:
        for batch in lines_of(part):
            held.append(batch)
            size += batch.nbytes
            if size >= BATCH_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def lines_of(part: ByteRange) -> Iterator[pa.RecordBatch]:
    """The lines of a range, a few megabytes at a time."""
    system, path, _ = _open(part.file)
    with system.open_input_file(path) as file:
        # a range that begins in a line leaves it to the range before
        at = part.start if part.first else part.start - 1
        skip, rest = not part.first, b""
        offsets, lines, held = [], [], 0
        behind = BEHIND_BYTES
        while at < part.end:
            # up to the end of the range, then a little at first, as only the rest of a line is wanted
            size = part.stop - at
            if size <= 0:
                size, behind = behind, behind * 2
            data = file.read_at(min(LOOK_BYTES * 16, size, part.end - at), at)
            if not data:
                break
            at += len(data)
            rest += data
            start = at - len(rest)
            pieces = rest.split(b"\n")
            rest = pieces.pop()
            for piece in pieces:
                if skip:
                    skip = False
                elif start < part.stop:
                    offsets.append(start)
                    lines.append(piece)
                    held += len(piece)
                start += len(piece) + 1
            if skip and at >= part.stop:
                # the line before goes on behind the range, so none begins here
                break
            if held >= BATCH_BYTES:
                yield _batch(part.file, offsets, lines)
                offsets, lines, held = [], [], 0
            if start >= part.stop:
                break
        if lines:
            yield _batch(part.file, offsets, lines)


def _batch(file: str, offsets: list[int], lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([file] * len(lines), pa.string()),
            pa.array(offsets, pa.int64()),
            pa.array([line.decode("utf-8", "replace") for line in lines], pa.string()),
            pa.array([o + len(line) + 1 for o, line in zip(offsets, lines, strict=True)], pa.int64()),
        ],
        names=["file", "offset", "line", "end"],
    )


class _Files:
    """What the batch and the stream reader share: the files of a folder and where their last lines end."""

    def __init__(self, options: dict):
        self._path = options["path"]
        self._range = int(options.get("rangebytes", RANGE_BYTES))
        self._tasks = int(options.get("tasks", 1))
        self._looked: dict[str, tuple[int, int]] = {}

    def ends(self) -> dict[str, int]:
        """The end of the last complete line of each file; only files of another size are looked into."""
        system, path, prefix = _open(self._path)
        looked = {}
        for info in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
            hidden = any(step[:1] in "._" for step in info.path[len(path) :].strip("/").split("/"))
            if info.type == fs.FileType.File and info.size and not hidden:
                name = prefix + info.path
                size, end = self._looked.get(name, (0, 0))
                if size != info.size:
                    end = last_line_end(system, info.path, info.size)
                looked[name] = info.size, end
        self._looked = looked
        return {name: end for name, (_, end) in looked.items()}


class _Batch(_Files, DataSourceReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self._before = json.loads(options.get("seen", "{}"))

    def partitions(self) -> list[InputPartition]:
        now, before = self.ends(), {}
        for name, size in self._before.items():
            if 0 < size <= now.get(name, -1):
                # a size seen may lie in a line, which is then read whole
                system, path, _ = _open(name)
                before[name] = last_line_end(system, path, size)
            elif name in now and size <= self._looked[name][0]:
                before[name] = now[name]
        return dealt(byte_ranges(before, now, self._range), self._tasks) or [ByteRanges([])]

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        return lines_of_all(partition.ranges)


class _Stream(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.ends()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return dealt(byte_ranges(start, end, self._range), self._tasks)

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        return lines_of_all(partition.ranges)


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(dict(self.options))


def growing_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A stream of the complete lines of the files in a folder, however they grow."""
    spark.dataSource.register(GrowingLines)
    reader = spark.readStream.format(FORMAT).option("rangeBytes", range_bytes)
    return reader.option("tasks", spark.sparkContext.defaultParallelism).load(path)


def lines_since(
    spark: SparkSession, path: str, seen: dict[str, int], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The complete lines that have ended behind the sizes in ``seen``; a file not named is new.

    A file that has become shorter than its size there counts as new too.
    """
    spark.dataSource.register(GrowingLines)
    reader = spark.read.format(FORMAT).option("rangeBytes", range_bytes)
    reader = reader.option("tasks", spark.sparkContext.defaultParallelism)
    return reader.option("seen", json.dumps(seen)).load(path)
