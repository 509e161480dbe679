"""Run events: streams, states, metrics, checkpoints, uploads.

All per-run results come from partial aggregates (``max_by``, ``min``, ``count``), never from a
window over a run's rows, so one run may hold any share of the events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_join, null_safe_join
from millrace.operators.position import ordered_position
from millrace.session import materialize

# Events that end a stream.
TERMINAL_TRAINING = ("complete", "failed", "cancelled", "stream_end")
TERMINAL_DEPLOYMENT = ("deployment_ready", "deployment_failed", "stream_end")
TERMINAL_INFERENCE = ("complete", "error")
# States that end an operation.
SUCCESS_STATES = ("completed", "ready", "success", "SUCCESS")
FAILURE_STATES = ("failed", "failure", "FAILURE", "cancelled", "revoked", "REVOKED")
ERROR_KEYS = ("error", "error_message")
# Events of an upload batch, and the longest error texts of the event format.
BATCH_EVENTS = 50
SUMMARY_CHARS = 500
TRACEBACK_CHARS = 8192
SCHEMA_VERSION = "1"
# Minutes of a gap that one row stands for at most.
GAP_BLOCK = 4096


def first_terminal(events: DataFrame, stream: str, seq: str, event: str,
                   terminal: Sequence[str]) -> DataFrame:
    """``(stream, end, n)``: sequence of the first terminal event, null when there is none."""
    return events.groupBy(stream).agg(
        F.min(F.when(F.col(event).isin(*terminal), F.col(seq))).alias("_end"),
        F.count(F.lit(1)).alias("_n"),
    )


def until_terminal(
    events: DataFrame,
    stream: str,
    seq: str,
    event: str = "event",
    terminal: Sequence[str] = TERMINAL_TRAINING,
) -> DataFrame:
    """Each stream's rows up to and including its first terminal event."""
    ends = first_terminal(events, stream, seq, event, terminal)
    marked = lookup_join(events, ends, [stream], weight="_n")
    return marked.filter(F.col("_end").isNull() | (F.col(seq) <= F.col("_end"))).drop("_end")


def dropped_streams(
    events: DataFrame,
    stream: str,
    event: str = "event",
    terminal: Sequence[str] = TERMINAL_INFERENCE,
) -> DataFrame:
    """``(stream, dropped)``: a stream without terminal event broke off."""
    return events.groupBy(stream).agg(
        (~F.bool_or(F.col(event).isin(*terminal))).alias("dropped")
    )


def drop_heartbeats(events: DataFrame, event: str = "event", include: bool = False) -> DataFrame:
    return events if include else events.filter(F.col(event) != "heartbeat")


def resume_after(
    events: DataFrame, cursors: DataFrame, stream: str, seq: str
) -> DataFrame:
    """Rows beyond each stream's cursor ``(stream, cursor)``; all rows where there is none."""
    joined = lookup_join(events, cursors.select(stream, "cursor"), [stream])
    return joined.filter(F.col("cursor").isNull() | (F.col(seq) > F.col("cursor"))).drop("cursor")


def filter_metrics(
    metrics: DataFrame,
    metric_type: str | None = None,
    epoch_start: int | None = None,
    epoch_end: int | None = None,
) -> DataFrame:
    """Metric rows by type and epoch, both ends included."""
    if metric_type is not None:
        metrics = metrics.filter(F.col("metric_type") == metric_type)
    if epoch_start is not None:
        metrics = metrics.filter(F.col("epoch") >= epoch_start)
    if epoch_end is not None:
        metrics = metrics.filter(F.col("epoch") <= epoch_end)
    return metrics


def filter_logs(
    logs: DataFrame,
    level: str | None = None,
    search: str | None = None,
    source: str | None = None,
    start: object = None,
    end: object = None,
) -> DataFrame:
    """Log rows by level, source, case-insensitive text and time (both ends included)."""
    if level is not None:
        logs = logs.filter(F.col("level") == level)
    if source is not None:
        logs = logs.filter(F.col("source") == source)
    if search is not None:
        logs = logs.filter(F.contains(F.lower("message"), F.lit(search.lower())))
    kind = logs.schema["ts"].dataType
    if start is not None:
        logs = logs.filter(F.col("ts") >= F.lit(start).cast(kind))
    if end is not None:
        logs = logs.filter(F.col("ts") <= F.lit(end).cast(kind))
    return logs


def epoch_summary(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last value of each metric in each epoch of a run, by ``order``."""
    return metrics.groupBy("run", "epoch", "metric").agg(
        F.max_by("value", F.struct(*order)).alias("value")
    )


def metric_summary(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """Count, min, max, mean, first and last value of each metric of a run."""
    place = F.struct(*order)
    return metrics.groupBy("run", "metric").agg(
        F.count("value").alias("n"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
        F.min_by("value", place).alias("first_value"),
        F.max_by("value", place).alias("last_value"),
    )


def explode_metrics(events: DataFrame, metrics: str = "metrics") -> DataFrame:
    """One row per entry of the metrics map."""
    rest = [c for c in events.columns if c != metrics]
    return events.select(*rest, F.explode(metrics).alias("metric", "value"))


def progress(events: DataFrame, run: str = "run") -> DataFrame:
    """Furthest epoch of each run, the declared total and the percentage done."""
    reached = F.max("epoch")
    total = F.max("total_epochs")
    return events.groupBy(run).agg(
        reached.alias("current_epoch"),
        total.alias("total_epochs"),
        F.when(total > 0, F.least(reached * 100.0 / total, F.lit(100.0)))
        .otherwise(0.0)
        .alias("progress_percentage"),
    )


def minute_series(
    points: DataFrame, key: str, ts: str, value: str, fill: float = 0.0
) -> DataFrame:
    """One row per minute between a key's first and last point: count and mean, gaps filled.

    Only the gap behind a minute that has points is filled, first by blocks of blocks of minutes, then
    by blocks, then by minutes: no array is longer than ``GAP_BLOCK``, however long the gap.
    """
    minute = F.date_trunc("minute", F.col(ts))
    found = points.groupBy(key, minute.alias("minute")).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean_value")
    )
    at = F.expr("unix_seconds(minute) div 60")
    following = F.lead("_at").over(Window.partitionBy(key).orderBy("_at"))
    present = found.withColumn("_at", at).withColumn("_next", following)
    # the minutes from _from up to and without _to, in ever shorter stretches
    gaps = present.select(key, (F.col("_at") + 1).alias("_from"), F.col("_next").alias("_to")).filter("_from < _to")
    for step in (GAP_BLOCK**2, GAP_BLOCK, 1):
        starts = F.sequence("_from", F.col("_to") - 1, F.lit(step).cast("bigint"))
        cut = gaps.select(key, F.explode(starts).alias("_from"), F.col("_to").alias("_stop"))
        gaps = cut.select(key, "_from", F.least(F.col("_from") + step, "_stop").alias("_to"))
    filled = gaps.select(
        key,
        F.timestamp_seconds(F.col("_from") * 60).alias("minute"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(fill).cast("double").alias("mean_value"),
    )
    known = found.select(key, "minute", "n", F.coalesce("mean_value", F.lit(fill)).alias("mean_value"))
    return known.unionByName(filled)


def final_events(events: DataFrame, run: str = "run", kind: str = "type") -> DataFrame:
    """The closing event of each run: ``failed`` if it reported an error, else ``complete``."""
    return events.groupBy(run).agg(
        F.when(F.bool_or(F.col(kind) == "error"), "failed").otherwise("complete").alias("final")
    )


def run_state(events: DataFrame, order: Sequence[str], run: str = "run") -> DataFrame:
    """The last reported state of each run."""
    state = F.struct("epoch", "step", "latest_checkpoint_path", "latest_checkpoint_id", "last_update")
    last = F.max_by(state, F.struct(*order)).alias("s")
    return events.groupBy(run).agg(last).select(run, "s.*")


def _checkpoint_rank(order: str) -> list[Column]:
    # a field that is absent or of another type ranks lowest; the later input wins a tie
    return [
        F.coalesce(F.col("epoch"), F.lit(-1)),
        F.coalesce(F.col("step"), F.lit(-1)),
        F.coalesce(F.col("created_at"), F.lit("")),
        F.col(order),
    ]


def latest_checkpoint(checkpoints: DataFrame, run: str = "run", order: str = "row_index") -> DataFrame:
    """The checkpoint id with the greatest (epoch, step, created_at) of each run."""
    rank = F.struct(*_checkpoint_rank(order))
    return checkpoints.groupBy(run).agg(F.max_by("id", rank).alias("checkpoint_id"))


def best_checkpoint(checkpoints: DataFrame, run: str = "run", order: str = "row_index") -> DataFrame:
    """The latest checkpoint marked best, or the latest of all where none is marked."""
    marked = F.coalesce(F.col("is_best"), F.lit(False))
    rank = F.struct(marked, *_checkpoint_rank(order))
    return checkpoints.groupBy(run).agg(F.max_by("id", rank).alias("checkpoint_id"))


def operation_outcome(
    states: DataFrame,
    operation: str,
    timeout_seconds: float,
    ts: str = "ts",
    state: str = "state",
    success: Sequence[str] = SUCCESS_STATES,
    failure: Sequence[str] = FAILURE_STATES,
    error_keys: Sequence[str] = ERROR_KEYS,
) -> DataFrame:
    """``(operation, outcome, state, detail)``: the first end state within the deadline.

    The deadline counts from the operation's first row. ``detail`` is the first present error text
    of a failure; without an end state in time the outcome is ``timeout``.
    """
    ended = F.col(state).isin(*success, *failure)
    detail = F.coalesce(*[F.col(k) for k in error_keys])
    end = F.min(F.when(ended, F.struct(F.col(ts).alias("at"), F.col(state).alias("state"),
                                       detail.alias("detail"))))
    per = states.groupBy(operation).agg(F.min(ts).alias("start"), end.alias("end"))
    deadline = F.col("start") + F.make_dt_interval(secs=F.lit(timeout_seconds).cast("decimal(18,6)"))
    timely = F.col("end").isNotNull() & (F.col("end.at") <= deadline)
    return per.select(
        operation,
        F.when(timely & F.col("end.state").isin(*success), "success")
        .when(timely, "failure")
        .otherwise("timeout")
        .alias("outcome"),
        F.when(timely, F.col("end.state")).alias("state"),
        F.when(timely & F.col("end.state").isin(*failure), F.col("end.detail")).alias("detail"),
    )


def top_per_group(
    df: DataFrame, group: str, order: Sequence[Column], keys: Sequence[str], k: int, salts: int = 64
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their 0-based ``rank``.

    A group is first cut to ``k`` rows in each of ``salts`` parts, then as a whole, so no task ranks
    more than ``k * salts`` rows of one group.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salts)))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    kept = salted.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= k)
    whole = Window.partitionBy(group).orderBy(*order)
    ranked = kept.withColumn("rank", F.row_number().over(whole) - 1).filter(F.col("rank") < k)
    return ranked.drop("_salt", "_rn")


def upload_batches(
    events: DataFrame,
    run: str = "run",
    seq: str = "seq",
    event_id: str = "event_id",
    batch_size: int = BATCH_EVENTS,
    backlog: int | None = None,
    sent: DataFrame | None = None,
) -> DataFrame:
    """Each event of a run once, oldest first, with its ``batch_id`` in the run.

    All events are delivered. Only a caller whose receiver fails may give a ``backlog``: the newest so
    many of each run are then kept. ``sent(run, n_sent)`` are events that were delivered before, by
    one row per run; the numbers go on behind them. Positions come from one range sort of the events,
    never from a window over a run, so one run may hold most of the events; the event itself is
    shuffled to find its copies and to be sorted, and is not looked up again.
    """
    once = events.dropDuplicates([run, event_id])
    placed = ordered_position(once, [run, seq, event_id], "_pos")
    spans = placed.groupBy(run).agg(F.min("_pos").alias("_from"), F.count(F.lit(1)).alias("_n"))
    spans = spans.withColumn("_all", F.col("_n"))
    if sent is not None:
        spans = null_safe_join(spans, sent.select(run, "n_sent"), [run], "left")
    joined = lookup_join(placed, spans, [run], weight="_n")
    place = F.col("_pos") - F.col("_from")
    if backlog is not None:
        first = F.greatest(F.col("_all") - F.lit(backlog), F.lit(0))
        joined = joined.filter(place >= first)
        place = place - first
    if sent is not None:
        place = place + F.coalesce("n_sent", F.lit(0))
    return joined.select(*events.columns, F.floor(place / batch_size).alias("batch_id"))


def upload_accounting(events: DataFrame, call: str, event_id: str = "event_id") -> DataFrame:
    """Events accepted and duplicates seen per upload call."""
    per = events.groupBy(call, event_id).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(call).agg(
        F.count(F.lit(1)).alias("accepted"), (F.sum("_n") - F.count(F.lit(1))).alias("duplicates")
    )


def trending(activity: DataFrame, item: str, ts: str, now: object, days: int = 7,
             k: int = 10) -> DataFrame:
    """The ``k`` items with most activity in the ``days`` up to ``now``."""
    end = F.lit(now).cast(activity.schema[ts].dataType)
    recent = activity.filter((F.col(ts) > end - F.make_dt_interval(days=F.lit(days))) & (F.col(ts) <= end))
    counts = recent.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(item)).limit(k)
