"""The query registry and what the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tabular import scan_indexed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its SQL, if any."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def indexed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan_indexed(spark, f"{folder}/{name}.parquet")


def joined(values: Column) -> Column:
    """An array as one text, so that results compare without array support."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), " ")


def one_line_base64(content: Column) -> Column:
    """Base64 without the line feeds that Spark may put in."""
    return F.translate(F.base64(content), "\r\n", "")


# Event kinds of the events table, read as the events of a training run.
EVENT_KINDS = {
    "click": "metric",
    "view": "progress",
    "signup": "heartbeat",
    "error": "failed",
    "purchase": "complete",
}


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """``(run, seq, ts, event, epoch, value, event_type)`` from the events table."""
    return run_columns(table(spark, folder, "events"))


def run_columns(events: DataFrame) -> DataFrame:
    kind = F
    for source, name in EVENT_KINDS.items():
        kind = kind.when(F.col("event_type") == source, name)
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("seq"),
        "ts",
        kind.alias("event"),
        F.get_json_object("props", "$.k").cast("bigint").alias("epoch"),
        "value",
        "event_type",
    )


RUN_EVENTS = """
ev as (
  select user_id as run, event_id as seq, ts,
         case event_type when 'click' then 'metric' when 'view' then 'progress'
              when 'signup' then 'heartbeat' when 'error' then 'failed'
              when 'purchase' then 'complete' end as event,
         cast(json_extract_string(props, '$.k') as bigint) as epoch, value, event_type
  from events)
"""
LINEITEM = "li as (select row_number() over () - 1 as row_index, * from lineitem)"
TOKEN_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
LINE_CLASS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def sql_tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{TOKEN_CLASS}'), lambda t: t <> '')"


# crc32 of the distinct tokens: the byte table from its rule, then one fold per token
CRC_TABLE = """
crc_table as (
  select list(v order by i) as t from (
    select i, list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) as v
    from range(256) r(i)))
"""


def sql_crc(words: str) -> str:
    """CTEs giving ``crc(token, h)`` for the distinct ``token`` of a CTE."""
    return f"""{CRC_TABLE},
crc as (
  select token, xor(list_reduce(
      list_prepend(4294967295::ubigint,
        [('0x' || substr(b, 2 * k + 1, 2))::ubigint for k in range(length(b) // 2)]),
      lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::bigint])), 4294967295::ubigint) as h
  from (select distinct token, hex(encode(token)) as b from {words}) d, crc_table)
"""
