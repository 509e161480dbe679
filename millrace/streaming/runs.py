"""Run events as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.records import event_id
from millrace.operators.joins import lookup_join
from millrace.operators.runs import (
    BATCH_EVENTS,
    ERROR_KEYS,
    FAILURE_STATES,
    SUCCESS_STATES,
    TERMINAL_INFERENCE,
    TERMINAL_TRAINING,
    first_terminal,
    upload_batches,
)
from millrace.session import fresh_path, materialize
from millrace.sources.eventlog import json_lines, offset_lines, raw_lines
from millrace.sources.growing import RANGE_BYTES, growing_lines
from millrace.streaming import closings
from millrace.streaming.closings import CLOSING, OUTCOME  # noqa: F401
from millrace.streaming.tables import latest_rows, newest_batch, read_batches, run_to_table, start, write_batch


def tail_log(
    spark: SparkSession, path: str, table: str, checkpoint: str | None = None, **trigger
):
    """Follow a folder of closed log segments into ``table``: ``(file, offset, line)``.

    The stream's checkpoint remembers the segments read, so a restart goes on where it stopped.
    """

    def handle(rows: DataFrame, batch: int) -> None:
        write_batch(json_lines(offset_lines(rows)).drop("end"), table, batch)

    return start(raw_lines(spark.readStream, path), handle, checkpoint, **trigger)


EVENT_LINES = "file string, offset bigint, line string"


def grow_log(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str | None = None,
    range_bytes: int = RANGE_BYTES,
    **trigger,
):
    """Follow a folder of growing logs into ``table``: ``(file, offset, line)`` of each event.

    The stream's offsets are the ends of the files' last complete lines. A micro-batch reads what the
    files have gained since, and a restart goes on where the checkpoint stands.
    """

    def handle(rows: DataFrame, batch: int) -> None:
        write_batch(json_lines(rows).drop("end"), table, batch)

    return start(growing_lines(spark, path, range_bytes), handle, checkpoint, **trigger)


def follow_log(spark: SparkSession, path: str, table: str, range_bytes: int = RANGE_BYTES) -> int:
    """One look at a folder of growing logs: new events go to ``table``, their number is returned.

    The checkpoint lies beside the table. A line that is still being written is taken up by a later
    look; a look that is repeated after a failure overwrites what it wrote before.
    """
    last = read_batches(spark, table, EVENT_LINES).agg(F.max("batch")).first()[0]
    grow_log(spark, path, table, f"{table}-checkpoint", range_bytes).awaitTermination()
    found = read_batches(spark, table, EVENT_LINES)
    return found.filter(F.col("batch") > (-1 if last is None else last)).count()


def with_event_ids(lines: DataFrame, run: str = "file") -> DataFrame:
    """Adds the stable id of each event: its own, else its run, its file's name and byte offset.

    A run may be written in several files, in each of which the offsets begin at 0.
    """
    own = F.get_json_object("line", "$.event_id")
    name = F.substring_index("file", "/", -1)
    place = F.concat_ws(":", name, F.col("offset")) if run != "file" else F.col("offset")
    return lines.withColumn("event_id", event_id(own, F.col(run), place))


def deduplicate(
    stream: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "30 days"
) -> DataFrame:
    """Each event once. Late rows are not dropped by intent: ``delay`` only bounds the state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def follow_until_terminal(
    stream: DataFrame,
    table: str,
    key: str,
    seq: str,
    event: str = "event",
    terminal: Sequence[str] = TERMINAL_TRAINING,
    checkpoint: str | None = None,
    **trigger,
):
    """Store each stream's rows up to its first terminal event, and nothing after it, ever.

    What is kept between batches is one row per ended stream, in a table beside the output. The
    rows themselves are never grouped, so one stream may hold most of a batch. Rows are taken in
    the order of their batches, inside a batch by ``seq``.
    """
    ends_path = f"{table}-ends"
    spark = stream.sparkSession
    ends_schema = f"{key} {stream.schema[key].dataType.simpleString()}, _end {stream.schema[seq].dataType.simpleString()}, _n bigint"

    def handle(rows: DataFrame, batch: int) -> None:
        rows = materialize(rows, "followed")
        ended = read_batches(spark, ends_path, ends_schema, before=batch).select(key, "_end", "_n")
        now = first_terminal(rows, key, seq, event, terminal)
        known = ended.select(key, F.col("_end").alias("_old"))
        open_now = now.join(known, key, "left")
        marks = open_now.select(
            key, "_n", F.coalesce("_old", "_end").alias("_end"), F.col("_old").isNotNull().alias("_past")
        )
        joined = lookup_join(rows, marks, [key], weight="_n")
        live = ~F.col("_past") & (F.col("_end").isNull() | (F.col(seq) <= F.col("_end")))
        write_batch(joined.filter(live).drop("_end", "_past"), table, batch)
        fresh = open_now.filter("_old is null and _end is not null").select(key, "_end", "_n")
        write_batch(fresh, ends_path, batch)

    return start(stream, handle, checkpoint, **trigger)


def stream_ends(spark: SparkSession, table: str, key: str, key_type: str = "bigint") -> DataFrame:
    """``(key, end)`` of the streams that have ended; those not listed broke off or still run."""
    schema = f"{key} {key_type}, _end bigint"
    return read_batches(spark, f"{table}-ends", schema).select(key, F.col("_end").alias("end"))


def deliver_stream(
    stream: DataFrame,
    table: str,
    run: str = "run",
    seq: str = "seq",
    key: str = "event_id",
    batch_size: int = BATCH_EVENTS,
    checkpoint: str | None = None,
    ts: str | None = None,
    keep: str = "30 days",
    **trigger,
):
    """Deliver every event once, in upload batches that are numbered on over all micro-batches.

    Which ids were delivered is the stream's own keyed state, spread by run and id; with an event time
    ``ts`` an id is forgotten ``keep`` of event time later. How many events a run has got so far lies
    beside the output, one row per run, written whole by each micro-batch. What was delivered is never
    read again, and one micro-batch or many give the same numbers if they come in order.
    """
    spark = stream.sparkSession
    kind = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = f"{run} {kind[run]}, n_sent bigint"

    def handle(rows: DataFrame, batch: int) -> None:
        rows = materialize(rows, "delivery")
        sent = newest_batch(spark, f"{table}-sent", schema, before=batch)
        write_batch(upload_batches(rows, run, seq, key, batch_size, sent=sent), table, batch)
        now = rows.groupBy(run).agg(F.count_distinct(key).alias("n_sent"))
        counted = sent.unionByName(now).groupBy(run).agg(F.sum("n_sent").alias("n_sent"))
        write_batch(counted, f"{table}-sent", batch)

    if ts is None:
        fresh = stream.dropDuplicates([run, key])
    else:
        fresh = stream.withWatermark(ts, keep).dropDuplicatesWithinWatermark([run, key])
    return start(fresh, handle, checkpoint, **trigger)


def final_events_stream(stream: DataFrame, run: str = "run", kind: str = "type") -> DataFrame:
    """The closing event of each run as known so far; run it in update mode."""
    failed = F.max((F.col(kind) == "error").cast("int"))
    return stream.groupBy(run).agg(F.when(failed == 1, "failed").otherwise("complete").alias("final"))


def run_state_stream(
    stream: DataFrame, order: Sequence[str], columns: Sequence[str], run: str = "run"
) -> DataFrame:
    """The last state of each run so far; run it in update mode."""
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("s")
    return stream.groupBy(run).agg(last).select(run, "s.*")


def run_latest(stream: DataFrame, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Run an update-mode stream over what is there and return the last row of each key."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "latest")
    run_to_table(stream, path, "update")
    return latest_rows(read_batches(spark, path, stream.schema), keys)


def operation_outcomes(
    stream: DataFrame,
    operation: str,
    timeout_seconds: float,
    ts: str = "ts",
    state: str = "state",
    success: Sequence[str] = SUCCESS_STATES,
    failure: Sequence[str] = FAILURE_STATES,
    error_keys: Sequence[str] = ERROR_KEYS,
    delay: str = "1 minute",
    keep_seconds: float = 86400.0,
) -> DataFrame:
    """Outcome of each operation as the stream decides it; see ``closings.operation_outcomes``."""
    return closings.operation_outcomes(
        stream, operation, timeout_seconds, ts, state, success, failure, error_keys, delay, keep_seconds
    )


def stream_closings(
    stream: DataFrame,
    key: str,
    seq: str,
    idle_seconds: float,
    ts: str = "ts",
    event: str = "event",
    terminal: Sequence[str] = TERMINAL_INFERENCE,
    delay: str = "1 minute",
) -> DataFrame:
    """Which streams have ended and which broke off; see ``closings.stream_closings``."""
    return closings.stream_closings(stream, key, seq, ts, event, terminal, idle_seconds, delay)
