"""Event logs as JSON Lines, and batched delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.runs import (
    BATCH_EVENTS,
    SCHEMA_VERSION,
    SUMMARY_CHARS,
    TRACEBACK_CHARS,
    upload_batches,
)


def event_rows(
    events: DataFrame,
    schema_version: str | None = SCHEMA_VERSION,
    summary_chars: int = SUMMARY_CHARS,
    traceback_chars: int = TRACEBACK_CHARS,
) -> DataFrame:
    """Events ready to be written: error texts cut to what the format holds, the version filled in."""
    changed: dict[str, Column] = {}
    if "technical_summary" in events.columns:
        changed["technical_summary"] = F.substring("technical_summary", 1, summary_chars)
    if "traceback" in events.columns:
        changed["traceback"] = F.substring("traceback", 1, traceback_chars)
    if schema_version is not None:
        given = F.col("schema_version") if "schema_version" in events.columns else F.lit(None)
        changed["schema_version"] = F.coalesce(given.cast("string"), F.lit(schema_version))
    return events.withColumns(changed)


def append_events(
    events: DataFrame, path: str, schema_version: str | None = SCHEMA_VERSION, **limits: int
) -> None:
    """Append one JSON line per event; absent fields are left out of the line."""
    event_rows(events, schema_version, **limits).write.mode("append").json(path)


def deliver_batches(
    events: DataFrame,
    path: str,
    run: str = "run",
    seq: str = "seq",
    event_id: str = "event_id",
    batch_size: int = BATCH_EVENTS,
    backlog: int | None = None,
) -> None:
    """Write every event in the batches of its run; writing the same events again changes nothing."""
    batches = upload_batches(events, run, seq, event_id, batch_size, backlog)
    batches.write.mode("overwrite").parquet(path)
