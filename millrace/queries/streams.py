"""Streams over the events table; each agrees with its batch twin."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.queries.registry import RUN_EVENTS, query, run_columns, table
from millrace.queries.scans import log_of, write_logs
from millrace.queries.windows import OUTCOMES, states
from millrace.session import fresh_path
from millrace.streaming import runs
from millrace.streaming.tables import read_batches, run_to_table


def grow_logs(lines, path, look, looks):
    """Append to each log's file the bytes of the given look, in the tasks that hold the logs."""
    target = path.removeprefix("file:")

    def append(key, rows):
        os.makedirs(target, exist_ok=True)
        data = "".join(line + "\n" for line in rows.sort_values("event_id")["line"]).encode()
        begin, end = len(data) * (look - 1) // looks, len(data) * look // looks
        # written over from its beginning, so a task that runs again leaves the same file
        with open(f"{target}/{key[0]}.jsonl", "r+b" if look > 1 else "wb") as file:
            file.seek(begin)
            file.write(data[begin:end])
        return pd.DataFrame({"log": [key[0]], "bytes": [end - begin]})

    lines.groupBy("log").applyInPandas(append, "log bigint, bytes bigint").write.format("noop").mode("overwrite").save()


def stream_events(spark, folder):
    """The events table as a file stream."""
    schema = table(spark, folder, "events").schema
    # a pattern, so that the table may be one file or a folder of files
    return spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")


def stream_runs(spark, folder):
    return run_columns(stream_events(spark, folder))


PARTS = 4


def stream_in_parts(spark, folder):
    """The run events as a stream of several micro-batches, each a stretch of time behind the last."""
    events = run_columns(table(spark, folder, "events"))
    path = fresh_path(spark, "parts")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - low) * PARTS / (high - low + 1))
    for number in range(PARTS):
        # one file each, as Spark takes files in the order in which they were written; read by many tasks
        events.filter(part == number).repartition(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query(
    "sm1_tail_log",
    """with l as (select user_id // 10 as log, event_id, '{"seq":' || event_id || ',"kind":"' || event_type || '"}' as line from events),
    o as (select *, sum(octet_length(encode(line)) + 1) over (partition by log order by event_id)
             - octet_length(encode(line)) - 1 as off from l)
    select cast(log as bigint) as log, cast(off as bigint) as "offset", event_id as seq,
           log || ':' || cast(off as bigint) as event_id from o""",
)
def tail_log(spark, folder):
    path, out = fresh_path(spark, "segments"), fresh_path(spark, "tailed")
    events = table(spark, folder, "events")
    line = F.to_json(F.struct(F.col("event_id").alias("seq"), F.col("event_type").alias("kind")))
    write_logs(events, line, path)
    runs.tail_log(spark, path, out).awaitTermination()
    found = read_batches(spark, out, "file string, offset bigint, line string")
    named = runs.with_event_ids(found.withColumn("log", log_of("file")), "log")
    # the ids name the file too, which differs from run to run; what they must be is distinct
    distinct = named.groupBy("event_id").agg(F.first("log").alias("log"), F.first("offset").alias("offset"), F.first("line").alias("line"))
    parts = F.split("event_id", ":")
    return distinct.select(
        "log", "offset", F.get_json_object("line", "$.seq").cast("bigint").alias("seq"),
        F.concat_ws(":", F.element_at(parts, 1), F.element_at(parts, -1)).alias("event_id"),
    )


GROWTH = """with l as (select user_id // 10 as log, event_id,
      '{"seq":' || event_id || ',"kind":"' || event_type || '"}' as line from events),
    o as (select *, octet_length(encode(line)) + 1 as n,
             sum(octet_length(encode(line)) + 1) over (partition by log order by event_id) as stop,
             sum(octet_length(encode(line)) + 1) over (partition by log) as total from l)"""


@query(
    "sm1_follow_growing_log",
    f"""{GROWTH} select cast(log as bigint) as log, cast(stop - n as bigint) as "offset", event_id as seq,
      cast(case when stop <= total // 3 then 1 when stop <= total * 2 // 3 then 2 else 3 end as bigint) as look from o""",
)
def follow_growing_log(spark, folder):
    """Logs that grow by a third of their bytes between two looks, as a rule ending inside a line."""
    path, out = fresh_path(spark, "growing"), fresh_path(spark, "followed")
    events = table(spark, folder, "events")
    line = F.to_json(F.struct(F.col("event_id").alias("seq"), F.col("event_type").alias("kind")))
    lines = events.select(F.expr("user_id div 10").alias("log"), "event_id", line.alias("line"))
    for look in (1, 2, 3):
        grow_logs(lines, path, look, 3)
        runs.follow_log(spark, path, out, range_bytes=1 << 12)
    found = read_batches(spark, out, runs.EVENT_LINES)
    number = F.dense_rank().over(Window.orderBy("batch"))
    looks = found.select("batch").distinct().select("batch", number.cast("bigint").alias("look"))
    return found.join(looks, "batch").select(
        F.regexp_extract("file", r"(\d+)\.jsonl$", 1).cast("bigint").alias("log"),
        "offset",
        F.get_json_object("line", "$.seq").cast("bigint").alias("seq"),
        "look",
    )


@query("sm2_exactly_once", "select distinct user_id || ':' || json_extract_string(props, '$.k') as event_id from events")
def exactly_once(spark, folder):
    events = stream_events(spark, folder)
    key = F.concat_ws(":", "user_id", F.get_json_object("props", "$.k"))
    stream = events.select(key.alias("event_id"), F.col("ts").cast("timestamp").alias("ts"))
    out = fresh_path(spark, "once")
    run_to_table(runs.deduplicate(stream, delay="60 days").select("event_id"), out)
    return read_batches(spark, out, "event_id string").drop("batch")


@query(
    "sm3_follow_until_terminal",
    f"""with {RUN_EVENTS}, t as (select run, min(seq) as stop from ev where event in ('complete', 'failed') group by run)
    select run, seq, event from ev left join t using (run) where stop is null or seq <= stop""",
)
def follow_until_terminal(spark, folder):
    out = fresh_path(spark, "followed")
    stream = stream_in_parts(spark, folder).select("run", "seq", "event")
    runs.follow_until_terminal(stream, out, "run", "seq").awaitTermination()
    return read_batches(spark, out, stream.schema).drop("batch")


# The last minute of events is still open when the data end.
@query(
    "sm4_dropped_streams",
    f"""with {RUN_EVENTS}, w as (select max(ts) - interval 1 minute as mark from ev where run % 3 <> 0 or event <> 'complete'),
    p as (select run, date_trunc('minute', ts) as minute, min(ts) as first, max(ts) as last,
            min(case when event = 'complete' then seq end) as stop
          from ev, w where (run % 3 <> 0 or event <> 'complete') and date_trunc('minute', ts) + interval 1 minute <= mark group by all),
    g as (select run, first, last, stop, lead(first) over (partition by run order by first) as next from p),
    c as (select run, first, stop, stop is null as dropped from g, w
          where stop is not null or coalesce(next > last + interval 10 day, mark > last + interval 10 day)),
    r as (select *, row_number() over (partition by run order by first) as rn from c)
    select cast(run as varchar) as stream, stop as "end", dropped from r where rn = 1""",
)
def dropped_streams(spark, folder):
    # a third of the streams lose their closing event
    stream = stream_in_parts(spark, folder).filter("run % 3 <> 0 or event <> 'complete'")
    out = fresh_path(spark, "closings")
    closed = runs.stream_closings(stream, "run", "seq", 10 * 86400, terminal=["complete"])
    run_to_table(closed, out)
    return read_batches(spark, out, runs.CLOSING).drop("batch")


@query(
    "sm5_bounded_backlog",
    f"""with {RUN_EVENTS},
    k as (select run, seq, row_number() over (partition by run order by part, seq) - 1 as pos
      from (select run, seq, floor((epoch_us(ts) - min(epoch_us(ts)) over ()) * {PARTS} / (max(epoch_us(ts)) over () - min(epoch_us(ts)) over () + 1)) as part from ev))
    select run, seq, cast(pos // 15 as bigint) as batch_id from k""",
)
def bounded_backlog(spark, folder):
    event = F.concat_ws(":", "run", "seq").alias("event_id")
    stream = stream_in_parts(spark, folder).select("run", "seq", event)
    out = fresh_path(spark, "backlog")
    # every event comes twice in its micro-batch
    twice = stream.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    runs.deliver_stream(twice, out, batch_size=15).awaitTermination()
    return read_batches(spark, out, "run bigint, seq bigint, event_id string, batch_id bigint").select("run", "seq", "batch_id")


@query(
    "sm6_final_events",
    f"""with {RUN_EVENTS} select run, case when bool_or(event_type = 'error' and value > 45) then 'failed' else 'complete' end as final
    from ev group by run""",
)
def final_events(spark, folder):
    kind = F.when((F.col("event_type") == "error") & (F.col("value") > 45), "error").otherwise("metric")
    stream = stream_runs(spark, folder).withColumn("type", kind)
    return runs.run_latest(runs.final_events_stream(stream), ["run"])


@query(
    "sm7_run_state",
    f"""with {RUN_EVENTS}, r as (select *, row_number() over (partition by run order by ts desc, seq desc) as rn from ev)
    select run, epoch, seq as step, event from r where rn = 1""",
)
def run_state(spark, folder):
    stream = stream_runs(spark, folder).withColumn("step", F.col("seq"))
    return runs.run_latest(runs.run_state_stream(stream, ["ts", "seq"], ["epoch", "step", "event"]), ["run"])


@query("sm8_operation_outcomes", OUTCOMES)
def operation_outcomes(spark, folder):
    out = fresh_path(spark, "outcomes")
    # a run goes on long after its deadline; its operation stays known for as long as the data reach
    stream = states(stream_in_parts(spark, folder))
    outcomes = runs.operation_outcomes(stream, "operation", 6 * 3600, keep_seconds=366 * 86400)
    run_to_table(outcomes, out)
    return read_batches(spark, out, runs.OUTCOME).drop("batch")
