import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import catalog, integrity, joins, runs
from millrace.sinks import events as event_sink
from millrace.sinks import manifest


def test_checkpoints(spark):
    schema = "run string, id string, epoch bigint, step bigint, is_best boolean, created_at string, row_index bigint"
    rows = [
        ("r", "a", 5, 100, False, None, 0), ("r", "b", 3, 60, True, None, 1),
        ("tie", "x", 1, 1, None, "t", 0), ("tie", "y", 1, 1, None, "t", 1), ("tie", "z", None, 9, None, "u", 2),
    ]
    table = spark.createDataFrame(rows, schema)
    latest = {r["run"]: r["checkpoint_id"] for r in runs.latest_checkpoint(table).collect()}
    best = {r["run"]: r["checkpoint_id"] for r in runs.best_checkpoint(table).collect()}
    assert latest == {"r": "a", "tie": "y"} and best == {"r": "b", "tie": "y"}


def test_until_terminal_and_dropped(spark):
    rows = [("a", 1, "metric"), ("a", 2, "complete"), ("a", 3, "metric"), ("a", 4, "failed"), ("b", 1, "metric")]
    table = spark.createDataFrame(rows, "stream string, seq bigint, event string")
    out = {(r["stream"], r["seq"]) for r in runs.until_terminal(table, "stream", "seq").collect()}
    assert out == {("a", 1), ("a", 2), ("b", 1)}
    dropped = {r["stream"]: r["dropped"] for r in runs.dropped_streams(table, "stream").collect()}
    assert dropped == {"a": False, "b": True}


def test_operation_outcome(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [
        ("ok", t, "pending", None, None), ("ok", t + dt.timedelta(seconds=10), "ready", None, None), ("ok", t + dt.timedelta(seconds=12), "failed", "e", None),
        ("bad", t, "FAILURE", None, "second key"), ("late", t, "pending", None, None), ("late", t + dt.timedelta(seconds=31), "ready", None, None),
        ("edge", t, "pending", None, None), ("edge", t + dt.timedelta(seconds=30), "ready", None, None),
    ]
    table = spark.createDataFrame(rows, "op string, ts timestamp, state string, error string, error_message string")
    out = {r["op"]: (r["outcome"], r["detail"]) for r in runs.operation_outcome(table, "op", 30).collect()}
    assert out == {"ok": ("success", None), "bad": ("failure", "second key"), "late": ("timeout", None), "edge": ("success", None)}


def test_backlog_keeps_newest(spark):
    rows = [("r", i, f"e{i}") for i in range(10)] * 2
    table = spark.createDataFrame(rows, "run string, seq bigint, event_id string")
    out = runs.upload_batches(table, batch_size=2, backlog=5).orderBy("seq").collect()
    assert [(r["seq"], r["batch_id"]) for r in out] == [(5, 0), (6, 0), (7, 1), (8, 1), (9, 2)]


def test_delivery_is_idempotent(spark, tmp_path):
    table = spark.createDataFrame([("r", i, f"e{i}") for i in range(7)], "run string, seq bigint, event_id string")
    for _ in range(2):
        event_sink.deliver_batches(table, str(tmp_path / "out"), batch_size=3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_append_events(spark, tmp_path):
    rows = [("error", "s" * 600, "t" * 9000, None), ("metric", None, None, "7")]
    table = spark.createDataFrame(rows, "type string, technical_summary string, traceback string, schema_version string")
    path = str(tmp_path / "log")
    event_sink.append_events(table, path)
    event_sink.append_events(table, path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert len(lines) == 4
    error = next(x for x in lines if x["type"] == "error")
    assert (len(error["technical_summary"]), len(error["traceback"]), error["schema_version"]) == (500, 8192, "1")
    metric = next(x for x in lines if x["type"] == "metric")
    assert metric == {"type": "metric", "schema_version": "7"}


def test_top_per_group_is_whole(spark):
    table = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    out = runs.top_per_group(table, "g", [F.desc("id")], ["id"], 700).collect()
    assert {r["id"] for r in out} == set(range(3600, 5000))


def test_heartbeats_and_resume(spark):
    table = spark.createDataFrame([("a", 1, "heartbeat"), ("a", 2, "metric"), ("b", 1, "metric")], "s string, seq int, event string")
    assert runs.drop_heartbeats(table).count() == 2 and runs.drop_heartbeats(table, include=True).count() == 3
    cursors = spark.createDataFrame([("a", 1)], "s string, cursor int")
    assert {(r["s"], r["seq"]) for r in runs.resume_after(table, cursors, "s", "seq").collect()} == {("a", 2), ("b", 1)}


def retention_by_loop(entries, budget):
    total, gone = sum(e[1] for e in entries), set()
    for name, size, access, managed in sorted(entries, key=lambda e: (e[2] or 0, e[0])):
        if total <= budget:
            break
        if managed and name != "_staging":
            total -= size
            gone.add(name)
    return gone


@pytest.mark.parametrize("budget", [0, 500, 5000, 10**6])
def test_retention(spark, budget):
    entries = [(f"d{i:03}", i * 37 % 91, None if i % 11 == 0 else i * 13 % 29, i % 5 != 0) for i in range(200)]
    entries += [("_staging", 50, None, True), ("odd", 5, 1, None)]
    table = spark.createDataFrame(entries, "dataset_id string, size_bytes bigint, last_access bigint, managed boolean")
    plan = integrity.retention_plan(table, budget).collect()
    assert len(plan) == len(entries)
    assert {r["dataset_id"] for r in plan if r["evict"]} == retention_by_loop(entries, budget)


def test_lineage(spark):
    edges = [(0, None)] + [(i, i - 1) for i in range(1, 40)] + [(100, 0), (101, 0), (200, 999)]
    table = spark.createDataFrame(edges, "id bigint, parent_version_id bigint")
    out = {r["id"]: (r["root"], r["depth"]) for r in integrity.lineage(table).collect()}
    assert all(out[i] == (0, i) for i in range(40))
    assert out[100] == (0, 1) and out[200] == (200, 0) and len(out) == len(edges)
    with pytest.raises(ValueError, match="cycle"):
        integrity.lineage(spark.createDataFrame([(1, 2), (2, 1)], "id bigint, parent_version_id bigint"), 6)


def test_version_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "a", None), (2, "B", "x"), (3, "c", None), (4, "d", "y")], "k int, v string, w string")
    assert tuple(integrity.version_diff(old, new, "k").first()) == (0, 2, 1, 1)


def test_manifest(spark, tmp_path):
    files = spark.createDataFrame([("a", bytearray(b"x")), ("b", bytearray(b"yy"))], "file string, content binary")
    good = manifest.manifest_rows(files).select("file", "checksum")
    assert manifest.write_manifest(files, str(tmp_path / "m"), good).count() == 2
    bad = good.withColumn("checksum", F.lit("0"))
    with pytest.raises(ValueError, match="mismatch"):
        manifest.write_manifest(files, str(tmp_path / "n"), bad)
    assert not (tmp_path / "n").exists()
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.bin").write_bytes(b"abc")
    row = manifest.scan_manifest(spark, str(tmp_path / "f")).first()
    assert row["size_bytes"] == 3 and row["checksum"].startswith("ba7816bf")
    status = joins.verify_checksums(good.union(spark.createDataFrame([("c", None)], "file string, checksum string")), good)
    assert {r["file"]: r["status"] for r in status.collect()} == {"a": "ok", "b": "ok", "c": "missing"}


def test_union_rows(spark):
    left = spark.createDataFrame([(1, None)], "a int, b string")
    right = spark.createDataFrame([(3, "x")], "a int, c string")
    out = catalog.union_rows(left, right)
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect()), key=str) == [("1", None, "-"), ("3", "-", "x")]


def test_pages_agree(spark):
    table = spark.range(57).select("id", (F.col("id") % 5).alias("v"))
    first = catalog.paginate(table, 1, 10, "v", "id").collect()
    after = catalog.page_after(table, (first[-1]["v"], first[-1]["id"]), 10, "v", "id").collect()
    assert after == catalog.paginate(table, 2, 10, "v", "id").collect()
    assert tuple(catalog.page_info(table, 0, 10).first()) == (1, 6, 57)
    assert tuple(catalog.page_info(table.limit(0)).first()) == (1, 1, 0)


def test_lineage_with_a_popular_ancestor(spark):
    # two thirds of the versions hang on one parent
    edges = [(0, None), (1, 0)] + [(i, 1 if i % 3 else i - 1) for i in range(2, 300)]
    table = spark.createDataFrame(edges, "id bigint, parent_version_id bigint")
    depth = {0: 0}
    for child, parent in edges[1:]:
        depth[child] = depth[parent] + 1
    assert {r["id"]: (r["root"], r["depth"]) for r in integrity.lineage(table).collect()} == {k: (0, d) for k, d in depth.items()}


def test_pages_reach_rows_without_a_sort_value(spark):
    data = [(i, None if i % 3 == 0 else float(i % 5)) for i in range(30)]
    table = spark.createDataFrame(data, "id bigint, v double")
    for order in ("asc", "desc"):
        seen, last = [], None
        while page := catalog.page_after(table, last, 7, "v", "id", order).collect():
            seen += [r["id"] for r in page]
            last = (page[-1]["v"], page[-1]["id"])
        assert sorted(seen) == list(range(30))
        assert [i for i in seen if i % 3 == 0] == seen[20:]
    found = catalog.search(table.withColumn("name", F.lit("x")), "X", ["name"], sort_by="v").collect()
    assert found[0]["v"] == 4.0 and found[-1]["v"] is None


def test_every_event_is_delivered(spark):
    table = spark.range(10_050).selectExpr("'r' as run", "id as seq", "concat('e', id) as event_id")
    out = runs.upload_batches(table, batch_size=50)
    assert out.count() == 10_050
    assert out.filter("batch_id <> seq div 50").count() == 0


def test_a_gap_of_ten_years_on_one_key(spark, monkeypatch):
    from millrace.operators import runs as ops

    rows = [("a", "2016-01-01 00:00:30", 1.0), ("a", "2025-12-31 23:59:59", 3.0), ("a", "2025-12-31 23:59:01", 5.0), ("b", "2020-02-29 12:00:00", 2.0)]
    points = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    found = ops.minute_series(points, "k", "t", "v", fill=-1.0)
    total = found.groupBy("k").agg(
        F.count("*").alias("n"), F.count_distinct("minute").alias("minutes"), F.sum("n").alias("points"), F.min("minute").alias("a"), F.max("minute").alias("b")
    )
    out = {r["k"]: (r["n"], r["minutes"], r["points"], str(r["a"]), str(r["b"])) for r in total.collect()}
    minutes = (10 * 365 + 3) * 24 * 60
    assert out == {
        "a": (minutes, minutes, 3, "2016-01-01 00:00:00", "2025-12-31 23:59:00"),
        "b": (1, 1, 1, "2020-02-29 12:00:00", "2020-02-29 12:00:00"),
    }
    filled = found.filter("n = 0").agg(F.min("mean_value"), F.max("mean_value")).first()
    assert tuple(filled) == (-1.0, -1.0)


def test_short_blocks_fill_the_same_gaps(spark, monkeypatch):
    from millrace.operators import runs as ops

    points = spark.createDataFrame([("a", m * 60.0) for m in (0, 1, 5, 40, 41, 100)], "k string, s double")
    points = points.withColumn("t", F.timestamp_seconds("s"))
    expected = sorted(r["minute"] for r in ops.minute_series(points, "k", "t", "s").collect())
    monkeypatch.setattr(ops, "GAP_BLOCK", 3)
    assert sorted(r["minute"] for r in ops.minute_series(points, "k", "t", "s").collect()) == expected
    assert len(expected) == 101
