"""Large CSV and JSON files cut into blocks against the readers of whole files."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import pieces, tabular


def written(tmp_path, rows, line_end="\n"):
    folder = tmp_path / "csv"
    folder.mkdir()
    with (folder / "a.csv").open("w", newline="", encoding="utf-8") as file:
        csv.writer(file, lineterminator=line_end).writerows(rows)
    return str(folder)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_csv_with_breaks_in_quotes(spark, tmp_path, line_end):
    pick = random.Random(3)
    words = ["plain", "a,b", 'say "hi"', "two\nlines", "\n\n\n", '"', "ä ö", "x" * 40, '",\n"']
    rows = [[str(i), " ".join(pick.choices(words, k=3)), pick.choice(words), str(i / 4)] for i in range(600)]
    path = written(tmp_path, [["id", "first text", "second", "number"], *rows], line_end)
    table = tabular.scan_large_csv(spark, path, ",", block_bytes=1 << 12)
    assert table.dtypes == [("id", "bigint"), ("first text", "string"), ("second", "string"), ("number", "double")]
    found = sorted(tuple(r) for r in table.collect())
    assert found == [(int(a), b, c, float(d)) for a, b, c, d in rows]
    with pieces.block_size(spark, 1 << 12):
        assert pieces.csv_records(spark, path).select("block").distinct().count() >= 8


def test_a_record_that_covers_many_blocks(spark, tmp_path):
    long = "line of the long field\n" * 3000
    path = written(tmp_path, [["id", "text"], ["1", "short"], ["2", long], ["3", 'q"' + long], ["4", "end"]])
    found = tabular.scan_large_csv(spark, path, ",", block_bytes=1 << 12).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, "short"), (2, long), (3, 'q"' + long), (4, "end")]


def test_csv_agrees_with_the_reader_of_whole_files(spark, tmp_path):
    rows = [["a", "b", "c"], ["1", "", "true"], ["", "x", "false"], [" 3", '""', ""], ["4", "2020-01-01", "true"]]
    path = written(tmp_path, rows)
    large, whole = tabular.scan_large_csv(spark, path, ","), tabular.scan_csv(spark, path, ",")
    assert large.dtypes == whole.dtypes
    assert sorted(map(repr, large.collect())) == sorted(map(repr, whole.collect()))
    schema = tabular.T.StructType().add("a", "string").add("b", "string").add("c", "boolean")
    assert tabular.scan_large_csv(spark, path, ",", schema).schema["a"].dataType.simpleString() == "string"


def test_empty_csv(spark, tmp_path):
    path = written(tmp_path, [])
    assert tabular.scan_large_csv(spark, path, ",").count() == 0


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays(spark, tmp_path, indent):
    pick = random.Random(5)
    words = ["}", "{", '"', "\\", "\n", "]", "[", "},{", "ä", "\t", '\\"}']
    rows = [
        {"id": i, "text": "".join(pick.choices(words, k=6)), "in": {"deep": [{"x": pick.choice(words)}] * (i % 3)}}
        for i in range(400)
    ]
    for name, part in (("a", rows[:250]), ("b", rows[250:])):
        (tmp_path / f"{name}.json").write_text(json.dumps(part, indent=indent), encoding="utf-8")
    (tmp_path / "meta.json").write_text('{"rows": 400}')
    (tmp_path / "none.json").write_text(" [ ] ")
    table = tabular.scan_large_json(spark, str(tmp_path), block_bytes=1 << 12)
    found = {r["id"]: (r["text"], [d["x"] for d in r["in"]["deep"]]) for r in table.collect()}
    assert found == {r["id"]: (r["text"], [d["x"] for d in r["in"]["deep"]]) for r in rows}
    assert table.select(F.count_distinct("id")).first()[0] == 400
    with pieces.block_size(spark, 1 << 12):
        blocks = pieces.json_records(spark, str(tmp_path), tabular.JSON_FILES).select("file", "block").distinct()
        assert blocks.count() >= 8
    whole = tabular.scan_json(spark, str(tmp_path))
    assert table.select(whole.columns).dtypes == whole.dtypes


def task_count(spark, work):
    """The result of ``work`` and how many tasks its longest stage had."""
    context = spark.sparkContext
    context.setJobGroup("counted", "")
    try:
        found = work()
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(job).stageIds]
        return found, max(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_many_small_blocks_make_few_tasks(spark, tmp_path):
    rows = [[str(i), f'a "{i}"\n, b'] for i in range(2000)]
    path = written(tmp_path, [["id", "text"], *rows])
    table, tasks = task_count(spark, lambda: tabular.scan_large_csv(spark, path, ",", block_bytes=512))
    assert sorted(tuple(r) for r in table.collect()) == [(int(a), b) for a, b in rows]
    assert pieces.csv_records(spark, path, 512).select("block").distinct().count() >= 50
    assert tasks <= 2 * spark.sparkContext.defaultParallelism
    (tmp_path / "j.json").write_text(json.dumps([{"id": i, "in": {"x": "} {"}} for i in range(2000)]))
    table, tasks = task_count(spark, lambda: tabular.scan_large_json(spark, str(tmp_path), block_bytes=512))
    assert sorted(r["id"] for r in table.collect()) == list(range(2000))
    assert tasks <= 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_blocks_are_larger_where_a_task_would_open_too_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pieces, "TASK_BLOCKS", 2)
    rows = [[str(i), f'a "{i}"\n, b'] for i in range(4000)]
    path = written(tmp_path, [["id", "text"], *rows])
    table = tabular.scan_large_csv(spark, path, ",", block_bytes=512)
    assert sorted(tuple(r) for r in table.collect()) == [(int(a), b) for a, b in rows]
    blocks = pieces.csv_records(spark, path, 512).select("block").distinct().count()
    assert 2 <= blocks <= 2 * spark.sparkContext.defaultParallelism + 1


def test_text_is_looked_at_before_it_is_cast(spark):
    # a cast that fails throws, value by value; what the pattern leaves out must be what fails
    odd = ["", " ", "-", "+5", " 5 ", "\t5", "5\x00", "9223372036854775807", "9223372036854775808", "0" * 30 + "5"]
    odd += ["5.", ".5", ".", "1E+5", "e5", "1f", "1L", "0x1.8P-3f", "0x.8p1", "0x1", "inf", "-Infinity", "nan", "+NaN"]
    odd += ["TRUE", "t", "yes", "N", "0", "true\t", "ye\u017f", "tru", "\u0665", "1_0", "--5", "5\u00a0", "Customer#5"]
    values = spark.createDataFrame([(text,) for text in odd], "s string")
    for kind, pattern in tabular.CASTABLE.items():
        cast, looked = F.col("s").try_cast(kind).isNotNull(), F.col("s").rlike(pattern)
        assert values.filter(cast & ~looked).count() == 0
        assert {r["s"] for r in values.filter(~cast & looked).collect()} <= {"9223372036854775808"}
