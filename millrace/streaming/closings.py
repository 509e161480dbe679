"""What ends streams and operations, decided in the stream: keyed state with event-time timers.

Rows are reduced first: of the rows of one key in one minute only the earliest and the latest time, and the
first end, go on to its state. Spark sums these up in the tasks that read the rows, so a key that holds a
third of all rows sends one row per task and minute. State and timers then see a few rows per key, as plain
rows: a table per key would cost far more than what is done with it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Rows of one key are reduced to one per such window of event time.
WINDOW = "1 minute"

OUTCOME = "operation string, outcome string, state string, detail string"
CLOSING = "stream string, end bigint, dropped boolean"


def _reduced(rows: DataFrame, key: str, when: Column, end: Column, delay: str) -> DataFrame:
    """``(key, first, last, end)`` per key and window of event time; times in seconds."""
    at = (F.unix_micros("when") / 1e6).alias("at")
    timed = rows.select(F.col(key).cast("string").alias("key"), when.alias("when"), end.alias("end"))
    timed = timed.withWatermark("when", delay).select("*", at)
    parts = timed.groupBy("key", F.window("when", WINDOW)).agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.min("end").alias("end")
    )
    return parts.select("key", F.window_time("window").alias("when"), "first", "last", "end.*")


def _millis(seconds: float) -> int:
    return int(seconds * 1000) + 1


class _Outcomes(StatefulProcessor):
    """State of an operation: its first time, its earliest end, and whether it is done."""

    def __init__(self, timeout: float, keep: float, success: Sequence[str]):
        self._timeout, self._keep, self._success = timeout, keep, set(success)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState(
            "operation", "start double, ended double, state string, detail string, done boolean"
        )

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        start, ended, state, detail, done = self._state.get() or (None, None, None, None, False)
        if done:
            return
        known = start
        for row in rows:
            start = row["first"] if start is None else min(start, row["first"])
            # ends of two rows lie in different minutes
            if row["ended"] is not None and (ended is None or row["ended"] < ended):
                ended, state, detail = row["ended"], row["state"], row["detail"]
        if known is not None and start < known:
            self._handle.deleteTimer(_millis(known + self._timeout))
        timely = ended is not None and ended <= start + self._timeout
        self._state.update((start, ended, state, detail, timely))
        if timely:
            self._handle.registerTimer(_millis(start + self._timeout + self._keep))
            outcome = "success" if state in self._success else "failure"
            yield _row(OUTCOME, key[0], outcome, state, detail if outcome == "failure" else None)
        elif start != known:
            self._handle.registerTimer(_millis(start + self._timeout))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start, ended, state, detail, done = self._state.get()
        if done:
            self._state.clear()
            return
        self._state.update((start, ended, state, detail, True))
        self._handle.registerTimer(_millis(start + self._timeout + self._keep))
        yield _row(OUTCOME, key[0], "timeout", None, None)

    def close(self) -> None:
        pass


class _Closings(StatefulProcessor):
    """State of a stream: the time of its last row, and whether it is closed."""

    def __init__(self, idle: float):
        self._idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("stream", "last double, closed boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, closed = self._state.get() or (None, False)
        if closed:
            return
        known, found = last, None
        # a row per minute that has rows, in the order of their times
        parts = sorted(((row["first"], row["last"], row["seq"]) for row in rows), key=lambda part: part[0])
        for first, latest, end in parts:
            if last is not None and first - last > self._idle:
                found = _row(CLOSING, key[0], None, True)
                break
            last = latest if last is None else max(last, latest)
            if end is not None:
                found = _row(CLOSING, key[0], end, False)
                break
        if known is not None:
            self._handle.deleteTimer(_millis(known + self._idle))
        self._state.update((last, found is not None))
        if found is not None:
            yield found
        else:
            self._handle.registerTimer(_millis(last + self._idle))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, closed = self._state.get()
        if not closed:
            self._state.update((last, True))
            yield _row(CLOSING, key[0], None, True)

    def close(self) -> None:
        pass


def _row(schema: str, *values) -> Row:
    names = [field.split()[0] for field in schema.split(", ")]
    return Row(**dict(zip(names, values, strict=True)))


def operation_outcomes(
    stream: DataFrame,
    operation: str,
    timeout_seconds: float,
    ts: str,
    state: str,
    success: Sequence[str],
    failure: Sequence[str],
    error_keys: Sequence[str],
    delay: str = "1 minute",
    keep_seconds: float = 86400.0,
) -> DataFrame:
    """Outcome of each operation: once it has ended in time, or event time has passed its deadline.

    The deadline counts from the operation's first row. An operation that is done ignores later rows; its
    state is removed ``keep_seconds`` of event time after the deadline, so the state does not grow with
    all operations there ever were. An outcome appears a minute of event time later than its row, when
    the rows of that minute have been reduced. Operation and time are cast to text and ``timestamp``.
    """
    when = F.col(ts).cast("timestamp")
    present = [F.col(k) for k in error_keys if k in stream.columns]
    detail = F.coalesce(*present, F.lit(None).cast("string"))
    ended = (F.unix_micros(when) / 1e6).alias("ended")
    end = F.when(
        F.col(state).isin(*success, *failure), F.struct(ended, F.col(state).alias("state"), detail.alias("detail"))
    )
    parts = _reduced(stream, operation, when, end, delay)
    return parts.groupBy("key").transformWithState(
        _Outcomes(timeout_seconds, keep_seconds, success), OUTCOME, "append", "eventTime"
    )


def stream_closings(
    stream: DataFrame,
    key: str,
    seq: str,
    ts: str,
    event: str,
    terminal: Sequence[str],
    idle_seconds: float,
    delay: str = "1 minute",
) -> DataFrame:
    """``(stream, end, dropped)`` of each stream, once: at its terminal event, or when it has fallen silent.

    ``end`` is the sequence of the first terminal event of its minute. A stream that has no row for
    ``idle_seconds`` of event time has broken off: ``dropped`` is true and ``end`` null, and what comes
    later is not looked at. What is still open appears in a later micro-batch.
    """
    when = F.col(ts).cast("timestamp")
    end = F.when(F.col(event).isin(*terminal), F.struct(F.col(seq).cast("bigint").alias("seq")))
    parts = _reduced(stream, key, when, end, delay)
    return parts.groupBy("key").transformWithState(
        _Closings(idle_seconds), CLOSING, "append", "eventTime"
    )
