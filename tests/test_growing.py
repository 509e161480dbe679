"""Growing line files: byte ranges, restarts, files that shrink."""

import pytest
from pyspark.sql import functions as F

from millrace.sources import eventlog, growing
from millrace.streaming import runs, tables

LINES = [b"first", b"", b"x" * 50, b"\xc3\xa4\xff odd", b"last\r", b"y" * 7]


def read(file, ranges):
    found = []
    for part in ranges:
        for batch in growing.lines_of(part):
            found += batch.to_pylist()
    return found


@pytest.mark.parametrize("size", [1, 2, 3, 7, 16, 1000])
def test_ranges_give_every_line_once(tmp_path, size):
    file = tmp_path / "a.log"
    data = b"\n".join(LINES) + b"\n" + b"open"
    file.write_bytes(data)
    system, path, _ = growing._open(str(file))
    end = growing.last_line_end(system, path, len(data))
    assert end == len(data) - 4
    found = read(file, growing.byte_ranges({}, {str(file): end}, size))
    assert [r["line"] for r in found] == [line.decode("utf-8", "replace") for line in LINES]
    # the bytes of what was read are the bytes that the file has gained
    assert [r["offset"] for r in found] == [0] + [r["end"] for r in found[:-1]] and found[-1]["end"] == end
    later = read(file, growing.byte_ranges({str(file): found[2]["end"]}, {str(file): end}, size))
    assert later == found[3:]


def test_no_line_has_ended(tmp_path):
    file = tmp_path / "a.log"
    file.write_bytes(b"z" * 200_000)
    system, path, _ = growing._open(str(file))
    assert growing.last_line_end(system, path, 200_000) == 0
    assert growing.byte_ranges({}, {str(file): 0}, 10) == []


def test_sizes_seen_within_a_line_and_files_that_shrink(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "a.log").write_bytes(b"one\ntwo\nthree\n")
    (folder / "b.log").write_bytes(b"new\n")
    (folder / "_hidden").write_bytes(b"no\n")

    def lines(seen):
        seen = spark.createDataFrame([(f"file:{folder}/{n}", s) for n, s in seen], "file string, size bigint")
        rows = eventlog.new_lines(spark, str(folder), seen).collect()
        return sorted((r["file"].rsplit("/", 1)[1], r["offset"], r["line"]) for r in rows)

    assert lines([("a.log", 5), ("b.log", 4)]) == [("a.log", 4, "two"), ("a.log", 8, "three")]
    assert lines([("a.log", 14), ("b.log", 40)]) == [("b.log", 0, "new")]
    assert lines([("a.log", 14), ("b.log", 4), ("gone.log", 9)]) == []
    assert len(lines([])) == 4


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, table = tmp_path / "log", str(tmp_path / "t")
    folder.mkdir()
    log = folder / "a.jsonl"
    counts = []
    for part in (b'{"n":1}\n{"n":', b'2}\n', b"", b'{"n":3}\n{"n":4}\n{"n"'):
        with log.open("ab") as more:
            more.write(part)
        counts.append(runs.follow_log(spark, str(folder), table, range_bytes=8))
    assert counts == [1, 1, 0, 2]
    rows = tables.read_batches(spark, table, runs.EVENT_LINES)
    assert sorted(r["offset"] for r in rows.collect()) == [0, 8, 16, 24]
    assert rows.select(F.max("batch")).first()[0] == 2


def test_small_ranges_share_tasks_and_read_little(tmp_path, monkeypatch):
    file = tmp_path / "a.log"
    data = b"".join(b"%06d\n" % i for i in range(100_000)) + b"z" * 300_000 + b"\n"
    file.write_bytes(data)
    ranges = growing.byte_ranges({}, {str(file): len(data)}, 1 << 12)
    parts = growing.dealt(ranges, 4)
    assert len(ranges) > 200 and len(parts) == 4
    assert [r for p in parts for r in p.ranges] == ranges and growing.dealt([], 4) == []
    sizes = []
    whole = growing._open

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *error):
            self.file.close()

        def read_at(self, size, at):
            sizes.append(size)
            return self.file.read_at(size, at)

    class System:
        @staticmethod
        def open_input_file(path):
            return Counted(whole(path)[0].open_input_file(path))

    monkeypatch.setattr(growing, "_open", lambda uri: (System, uri, "file:"))
    batches = [list(growing.lines_of_all(p.ranges)) for p in parts]
    assert max(len(b) for b in batches) == 1
    rows = [r for part in batches for b in part for r in b.to_pylist()]
    assert "".join(r["line"] + "\n" for r in rows).encode() == data
    # a range reads itself and the rest of a line, not a megabyte behind it
    assert sum(sizes) < 4 * len(data)


def test_large_ranges_have_tasks_of_their_own():
    ranges = growing.byte_ranges({}, {"a": 1 << 30}, growing.RANGE_BYTES)
    assert [len(p.ranges) for p in growing.dealt(ranges, 2)] == [1] * 16
