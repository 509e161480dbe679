"""One registered query per operator, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from millrace.queries import (  # noqa: F401
    aggregates,
    columns,
    hooks,
    joins,
    media,
    scalars,
    scans,
    sinks,
    sorts,
    splits,
    streams,
    versions,
    windows,
)
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
