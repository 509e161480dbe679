"""Streams read in several ordered batches agree with their batch twins."""

import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from millrace.operators import runs as batch
from millrace.streaming import closings, runs, tables

SCHEMA = "run bigint, seq bigint, event string, ts timestamp"
EVENTS = [
    (1, 1, "metric"), (2, 2, "metric"), (1, 3, "complete"), (1, 4, "metric"), (3, 5, "metric"),
    (2, 6, "failed"), (1, 7, "failed"), (3, 8, "metric"), (2, 9, "metric"), (1, 10, "metric"),
]


@pytest.fixture
def source(spark, tmp_path):
    """Ten events in five files, read one file per micro-batch."""
    start = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    folder = tmp_path / "in"
    folder.mkdir()
    import os
    import time

    for i in range(5):
        rows = [
            {"run": r, "seq": s, "event": e, "ts": (start + dt.timedelta(hours=s)).isoformat()}
            for r, s, e in EVENTS[2 * i : 2 * i + 2]
        ]
        file = folder / f"{i}.json"
        file.write_text("\n".join(map(json.dumps, rows)) + "\n")
        os.utime(file, (time.time() - 100 + i,) * 2)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))


def static(spark):
    start = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(r, s, e, start + dt.timedelta(hours=s)) for r, s, e in EVENTS], SCHEMA)


def test_until_terminal_over_batches(spark, source, tmp_path):
    table = str(tmp_path / "out")
    runs.follow_until_terminal(source, table, "run", "seq").awaitTermination()
    out = tables.read_batches(spark, table, SCHEMA)
    expected = batch.until_terminal(static(spark), "run", "seq")
    assert {(r["run"], r["seq"]) for r in out.collect()} == {(r["run"], r["seq"]) for r in expected.collect()}
    assert out.select("batch").distinct().count() > 1
    ends = {r["run"]: r["end"] for r in runs.stream_ends(spark, table, "run").collect()}
    assert ends == {1: 3, 2: 6}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(3)
    for _ in range(2):
        tables.write_batch(rows, path, 0)
        tables.write_batch(rows, path, 1)
    assert tables.read_batches(spark, path, "id bigint").count() == 6
    assert tables.read_batches(spark, path, "id bigint", before=1).count() == 3
    assert tables.read_batches(spark, str(tmp_path / "none"), "id bigint").count() == 0


def test_duplicates_across_batches(spark, source, tmp_path):
    path = str(tmp_path / "once")
    once = runs.deduplicate(source.select(F.col("run").alias("event_id"), "ts"))
    tables.run_to_table(once.select("event_id"), path)
    assert sorted(r["event_id"] for r in tables.read_batches(spark, path, "event_id bigint").collect()) == [1, 2, 3]


def test_state_and_final_event(spark, source):
    state = runs.run_latest(runs.run_state_stream(source, ["seq"], ["seq", "event"]), ["run"])
    assert {r["run"]: (r["seq"], r["event"]) for r in state.collect()} == {1: (10, "metric"), 2: (9, "metric"), 3: (8, "metric")}


def test_final_events(spark, source):
    kinds = source.withColumn("type", F.when(F.col("event") == "failed", "error").otherwise("metric"))
    out = runs.run_latest(runs.final_events_stream(kinds), ["run"])
    assert {r["run"]: r["final"] for r in out.collect()} == {1: "failed", 2: "failed", 3: "complete"}


def test_outcomes(spark, source, tmp_path):
    def states(events):
        state = F.when(F.col("event") == "complete", "ready").when(F.col("event") == "failed", "failed").otherwise("running")
        return events.select(F.col("run").cast("string").alias("operation"), "ts", state.alias("state"),
                             F.lit("broken").alias("error"), F.lit(None).cast("string").alias("error_message"))

    path = str(tmp_path / "out")
    # the deadlines of runs 1 and 2 lie inside the data, that of run 3 after its end
    tables.run_to_table(runs.operation_outcomes(states(source), "operation", 4 * 3600), path)
    found = {r["operation"]: (r["outcome"], r["state"], r["detail"]) for r in tables.read_batches(spark, path, runs.OUTCOME).collect()}
    twin = batch.operation_outcome(states(static(spark)), "operation", 4 * 3600).collect()
    expected = {r["operation"]: (r["outcome"], r["state"], r["detail"]) for r in twin}
    assert expected["1"] == ("success", "ready", None) and expected["2"] == ("failure", "failed", "broken")
    assert {k: found[k] for k in ("1", "2")} == {k: expected[k] for k in ("1", "2")}


def test_tail_resumes(spark, tmp_path):
    folder, table, check = tmp_path / "log", str(tmp_path / "t"), str(tmp_path / "c")
    folder.mkdir()
    (folder / "a.jsonl").write_bytes(b'{"n":1}\n\n{"n":2,"event_id":"own"}\n{"half"')
    runs.tail_log(spark, str(folder), table, check).awaitTermination()
    (folder / "b.jsonl").write_bytes(b'{"n":3}\n')
    runs.tail_log(spark, str(folder), table, check).awaitTermination()
    lines = tables.read_batches(spark, table, "file string, offset bigint, line string")
    named = runs.with_event_ids(lines.withColumn("run", F.lit("r")), "run")
    ids = sorted(r["event_id"] for r in named.collect())
    # two segments of one run: the offsets are alike, the ids are not
    assert ids == ["own", "r:a.jsonl:0", "r:b.jsonl:0"]


def test_a_growing_log_is_followed_from_its_last_complete_line(spark, tmp_path):
    folder, table = tmp_path / "log", str(tmp_path / "t")
    folder.mkdir()
    log = folder / "a.jsonl"
    log.write_bytes(b'{"n":1}\n{"n":2')
    assert runs.follow_log(spark, str(folder), table) == 1
    assert runs.follow_log(spark, str(folder), table) == 0
    with log.open("ab") as more:
        more.write(b'2}\nnot json\n{"n":3}\n{"n"')
    (folder / "b.jsonl").write_bytes(b'{"n":9}\n')
    assert runs.follow_log(spark, str(folder), table) == 3
    with log.open("ab") as more:
        more.write(b':4}\n')
    assert runs.follow_log(spark, str(folder), table) == 1
    rows = tables.read_batches(spark, table, "file string, offset bigint, line string").collect()
    found = sorted((r["file"].rsplit("/", 1)[1], r["offset"], json.loads(r["line"])["n"]) for r in rows)
    assert found == [("a.jsonl", 0, 1), ("a.jsonl", 8, 22), ("a.jsonl", 26, 3), ("a.jsonl", 34, 4), ("b.jsonl", 0, 9)]


def test_delivery_over_batches(spark, source, tmp_path):
    path = str(tmp_path / "b")
    # every event comes twice, in one micro-batch or in several
    events = source.select("run", "seq", F.col("seq").cast("string").alias("event_id"))
    for _ in range(2):
        runs.deliver_stream(events, path, batch_size=1, checkpoint=str(tmp_path / "c")).awaitTermination()
    out = tables.read_batches(spark, path, "run bigint, seq bigint, event_id string, batch_id bigint").collect()
    assert sorted(r["seq"] for r in out) == list(range(1, 11))
    per_run = {}
    for r in sorted(out, key=lambda r: r["seq"]):
        per_run.setdefault(r["run"], []).append(r["batch_id"])
    assert all(ids == list(range(len(ids))) for ids in per_run.values())


def test_delivery_leaves_out_what_was_sent(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    schema = "run string, seq bigint, event_id string"
    for look, rows in enumerate([[("r", 1, "e1"), ("r", 2, "e2")], [("r", 2, "e2"), ("r", 3, "e3")], [("r", 1, "e1"), ("s", 1, "e1")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder))
        stream = spark.readStream.schema(schema).json(str(folder))
        runs.deliver_stream(stream, path, batch_size=2, checkpoint=str(tmp_path / "c")).awaitTermination()
    out = tables.read_batches(spark, path, schema + ", batch_id bigint")
    found = sorted((r["run"], r["seq"], r["batch_id"]) for r in out.collect())
    assert found == [("r", 1, 0), ("r", 2, 0), ("r", 3, 1), ("s", 1, 0)]


def delivered(spark, source, path):
    events = source.select("run", "seq", F.col("seq").cast("string").alias("event_id"))
    runs.deliver_stream(events, path, batch_size=2).awaitTermination()
    rows = tables.read_batches(spark, path, "run bigint, seq bigint, event_id string, batch_id bigint")
    return sorted((r["run"], r["seq"], r["batch_id"]) for r in rows.collect())


def test_numbers_are_the_same_over_one_or_five_batches(spark, source, tmp_path):
    whole = str(tmp_path / "in" / "*.json")
    at_once = spark.readStream.schema(SCHEMA).json(whole)
    expected = delivered(spark, at_once, str(tmp_path / "one"))
    assert delivered(spark, source, str(tmp_path / "five")) == expected
    # the third event of run 1 opens its second batch
    assert [b for r, _, b in expected if r == 1] == [0, 0, 1, 1, 2]


def test_delivered_rows_are_not_read_again(spark, tmp_path):
    folder, check = tmp_path / "in", str(tmp_path / "c")
    folder.mkdir()
    schema = "run string, seq bigint, event_id string"
    path = str(tmp_path / "out")
    for rows in ([("r", 1, "e1"), ("r", 2, "e2")], [("r", 2, "e2"), ("r", 3, "e3")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder))
        stream = spark.readStream.schema(schema).json(str(folder))
        runs.deliver_stream(stream, path, batch_size=2, checkpoint=check).awaitTermination()
        for file in (tmp_path / "out").rglob("*.parquet"):
            file.write_bytes(b"")  # whoever receives the batches may take them away
    sent = tables.newest_batch(spark, f"{path}-sent", "run string, n_sent bigint", before=9)
    assert [tuple(r) for r in sent.collect()] == [("r", 3)]


def test_outcomes_of_late_and_silent_operations(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    rows = [
        [("a", 0, "running"), ("b", 1, "running"), ("c", 2, "running")],
        [("a", 30, "ready"), ("b", 50, "running"), ("d", 55, "running")],
        [("b", 90, "failed"), ("d", 100, "running"), ("a", 110, "failed")],
        [("d", 150, "ready"), ("z", 400, "running")],
        [("z", 401, "ready"), ("end", 900, "running")],
    ]
    folder = tmp_path / "in"
    schema = "operation string, ts timestamp, state string, error string"
    for part in rows:
        data = [(o, start + dt.timedelta(minutes=m), s, f"at {m}") for o, m, s in part]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    path = str(tmp_path / "out")
    tables.run_to_table(runs.operation_outcomes(stream, "operation", 3600), path)
    found = {r["operation"]: (r["outcome"], r["state"], r["detail"]) for r in tables.read_batches(spark, path, runs.OUTCOME).collect()}
    assert found == {
        "a": ("success", "ready", None),
        "b": ("timeout", None, None),  # failed half an hour too late
        "c": ("timeout", None, None),
        "d": ("timeout", None, None),
        "z": ("success", "ready", None),
    }


def test_closings_over_batches(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    rows = [
        [("a", 1, 0, "metric"), ("b", 2, 1, "metric"), ("c", 3, 2, "metric")],
        [("a", 4, 30, "complete"), ("b", 5, 40, "metric")],
        [("a", 6, 60, "error"), ("b", 7, 70, "metric")],
        [("b", 8, 99, "error"), ("c", 9, 200, "complete"), ("d", 10, 210, "metric")],
        [("e", 11, 400, "metric")],
    ]
    folder = tmp_path / "in"
    schema = "stream string, seq bigint, ts timestamp, event string"
    for part in rows:
        data = [(k, s, start + dt.timedelta(minutes=m), e) for k, s, m, e in part]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    path = str(tmp_path / "out")
    tables.run_to_table(runs.stream_closings(stream, "stream", "seq", 3600), path)
    found = sorted((r["stream"], r["end"], r["dropped"]) for r in tables.read_batches(spark, path, runs.CLOSING).collect())
    # c fell silent for more than an hour before its end came; e may still go on
    assert found == [("a", 4, False), ("b", 8, False), ("c", None, True), ("d", None, True)]


class OneState:
    """The state and timers of one key, as a processor's handle."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_processors_take_plain_rows():
    held = OneState()
    outcomes = closings._Outcomes(100, 1000, ["ready"])
    outcomes.init(held)
    rows = [Row(first=9.0, ended=None, state=None, detail=None), Row(first=5.0, ended=7.0, state="bad", detail="d")]
    assert list(outcomes.handleInputRows(("a",), iter(rows[:1]), None)) == []
    assert held.timers == [109001]
    assert [tuple(r) for r in outcomes.handleInputRows(("a",), iter(rows[1:]), None)] == [("a", "failure", "bad", "d")]
    assert held.timers == [1105001] and held.value == (5.0, 7.0, "bad", "d", True)
    assert list(outcomes.handleInputRows(("a",), iter(rows), None)) == [] and held.calls == 3
    held = OneState()
    closed = closings._Closings(50)
    closed.init(held)
    rows = [Row(first=70.0, last=71.0, seq=9), Row(first=10.0, last=30.0, seq=None)]
    assert [tuple(r) for r in closed.handleInputRows(("s",), iter(rows), None)] == [("s", 9, False)]
    assert held.value == (71.0, True)
    held.value = None
    rows = [Row(first=90.0, last=91.0, seq=9), Row(first=10.0, last=30.0, seq=None)]
    assert [tuple(r) for r in closed.handleInputRows(("s",), iter(rows), None)] == [("s", None, True)]
