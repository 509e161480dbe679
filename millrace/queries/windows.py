"""Ordered work: factorize, checkpoints, next-token windows, retention, streams' ends."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import encode, integrity, runs
from millrace.queries.registry import (
    LINEITEM,
    RUN_EVENTS,
    indexed,
    joined,
    query,
    run_events,
    sql_tokens,
    table,
)


@query(
    "wn1_factorize",
    f"""with {LINEITEM}, c as (select l_returnflag as v, row_number() over (order by min(row_index)) - 1 as code
      from li group by l_returnflag)
    select cast(row_index as bigint) as row_index, cast(code as bigint) as code from li join c on v is not distinct from l_returnflag""",
)
def factorize(spark, folder):
    rows = indexed(spark, folder, "lineitem").select("row_index", "l_returnflag")
    return encode.factorize(rows, "l_returnflag").select("row_index", "code")


@query(
    "wn1_factorize_nulls",
    """with o as (select o_orderkey, case when o_orderstatus = 'P' then null else o_custkey end as v from orders),
    c as (select v, row_number() over (order by min(o_orderkey)) - 1 as code from o group by v)
    select o_orderkey, cast(code as bigint) as code from o join c on c.v is not distinct from o.v""",
)
def factorize_nulls(spark, folder):
    # a third of all rows share one value, null
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    rows = table(spark, folder, "orders").select("o_orderkey", value.alias("v"))
    return encode.factorize(rows, "v", "o_orderkey").select("o_orderkey", "code")


CHECKPOINTS = f"""{RUN_EVENTS}, cp as (
  select run, 'cp' || seq as id, seq, case when event <> 'heartbeat' then epoch end as epoch,
    cast(floor(value) as bigint) as step, case when event <> 'progress' then strftime(ts, '%Y-%m-%dT%H:%M:%S') end as created_at,
    event = 'complete' as is_best from ev)"""


def _checkpoints(spark, folder):
    event = F.col("event")
    return run_events(spark, folder).select(
        "run",
        F.concat(F.lit("cp"), F.col("seq")).alias("id"),
        F.col("seq").alias("row_index"),
        F.when(event != "heartbeat", F.col("epoch")).alias("epoch"),
        F.floor("value").alias("step"),
        F.when(event != "progress", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
        (event == "complete").alias("is_best"),
    )


@query(
    "wn2_latest_checkpoint",
    f"""with {CHECKPOINTS} select run, id as checkpoint_id from (select *, row_number() over (partition by run
      order by coalesce(epoch, -1) desc, coalesce(step, -1) desc, coalesce(created_at, '') desc, seq desc) as rn from cp) where rn = 1""",
)
def latest_checkpoint(spark, folder):
    return runs.latest_checkpoint(_checkpoints(spark, folder))


@query(
    "wn3_best_checkpoint",
    f"""with {CHECKPOINTS} select run, id as checkpoint_id from (select *, row_number() over (partition by run
      order by is_best desc, coalesce(epoch, -1) desc, coalesce(step, -1) desc, coalesce(created_at, '') desc, seq desc) as rn from cp) where rn = 1""",
)
def best_checkpoint(spark, folder):
    return runs.best_checkpoint(_checkpoints(spark, folder))


@query(
    "wn4_lm_sequences",
    f"""with d as (select doc_id, {sql_tokens('text')} as t from documents),
    w as (select doc_id, i as ix, t[i + 1] as token from (select doc_id, t, unnest(range(len(t))) as i from d)),
    g as (select *, row_number() over (order by doc_id, ix) - 1 as pos, count(*) over () as n from w),
    v as (select token, row_number() over (order by count(*) desc, min(pos)) as id from g group by token order by id limit 499),
    e as (select pos, n, coalesce(id, 0) as id from g left join v using (token)),
    c as (select pos // 129 as window_id, list(id order by pos) as ids from e where pos < (n // 129) * 129 group by all)
    select cast(window_id as bigint) as window_id, array_to_string(ids[1:128], ' ') as x, array_to_string(ids[2:129], ' ') as y from c""",
)
def lm_sequences(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    windows = encode.lm_sequences(docs, "text", ["doc_id"], 128, 500)
    return windows.select("window_id", joined(F.col("x")).alias("x"), joined(F.col("y")).alias("y"))


VOCABULARY = f"""w as (select doc_id, i as ix, t[i + 1] as token from
  (select doc_id, t, unnest(range(len(t))) as i from (select doc_id, {sql_tokens('text')} as t from documents)))"""


@query(
    "wn5_vocabulary",
    f"""with {VOCABULARY} select token, count(*) as n,
      cast(row_number() over (order by count(*) desc, min({{'a': doc_id, 'b': ix}})) as bigint) as id
    from w group by token order by id limit 499""",
)
def vocabulary(spark, folder):
    words = encode.words_of(table(spark, folder, "documents"), "text", ["doc_id"], store=False)
    return encode.vocabulary(words, ["doc_id"], 500)


@query(
    "wn5_vocabulary_uncapped",
    f"""with {VOCABULARY} select token, count(*) as n,
      cast(row_number() over (order by count(*) desc, min({{'a': doc_id, 'b': ix}})) as bigint) as id
    from w group by token""",
)
def vocabulary_uncapped(spark, folder):
    words = encode.words_of(table(spark, folder, "documents"), "text", ["doc_id"], store=False)
    return encode.vocabulary(words, ["doc_id"])


@query(
    "wn6_retention_plan",
    """with e as (select cast(doc_id as varchar) as dataset_id, n_chars as size_bytes, lang <> 'de' as managed,
        case when lang <> 'es' then (doc_id * 7919) % 1000 end as last_access from documents),
    s as (select *, sum(size_bytes) over (order by coalesce(last_access, 0), dataset_id) - size_bytes as freed
          from e where managed)
    select dataset_id, size_bytes, managed, last_access,
      (select sum(size_bytes) from e) - freed > 1000000 as evict from s
    union all select *, false from (select dataset_id, size_bytes, managed, last_access from e where not managed)""",
)
def retention_plan(spark, folder):
    docs = table(spark, folder, "documents")
    entries = docs.select(
        F.col("doc_id").cast("string").alias("dataset_id"),
        F.col("n_chars").alias("size_bytes"),
        (F.col("lang") != "de").alias("managed"),
        F.when(F.col("lang") != "es", (F.col("doc_id") * 7919) % 1000).alias("last_access"),
    )
    return integrity.retention_plan(entries, 1_000_000)


@query(
    "wn7_until_terminal",
    f"""with {RUN_EVENTS}, t as (select run, min(seq) as stop from ev where event in ('complete', 'failed') group by run)
    select run, seq, event from ev left join t using (run) where stop is null or seq <= stop""",
)
def until_terminal(spark, folder):
    return runs.until_terminal(run_events(spark, folder).select("run", "seq", "event"), "run", "seq")


STATES = f"""{RUN_EVENTS}, st as (select run, ts, case event when 'complete' then 'ready' when 'failed' then 'FAILURE' else 'running' end as state,
  case when epoch % 2 = 0 then 'code ' || epoch end as error, 'seq ' || seq as error_message from ev)"""


def states(events):
    """Run events read as the status history of one operation per run."""
    event = F.col("event")
    return events.select(
        F.col("run").cast("string").alias("operation"),
        "ts",
        F.when(event == "complete", "ready").when(event == "failed", "FAILURE").otherwise("running").alias("state"),
        F.when(F.col("epoch") % 2 == 0, F.concat(F.lit("code "), F.col("epoch"))).alias("error"),
        F.concat(F.lit("seq "), F.col("seq")).alias("error_message"),
    )


OUTCOMES = f"""with {STATES}, b as (select run, min(ts) as start from st group by run),
    f as (select st.*, start, row_number() over (partition by run order by ts) as rn from st join b using (run)
          where state in ('ready', 'FAILURE')),
    g as (select * from f where rn = 1 and ts <= start + interval 21600 second)
    select cast(b.run as varchar) as operation,
      case when g.state = 'ready' then 'success' when g.state = 'FAILURE' then 'failure' else 'timeout' end as outcome,
      g.state, case when g.state = 'FAILURE' then coalesce(g.error, g.error_message) end as detail
    from b left join g using (run)"""


@query("wn8_operation_outcome", OUTCOMES)
def operation_outcome(spark, folder):
    return runs.operation_outcome(states(run_events(spark, folder)), "operation", 6 * 3600)


@query(
    "wn9_progress",
    f"""with {RUN_EVENTS} select run, max(epoch) as current_epoch, cast(max(100) as bigint) as total_epochs,
      round(max(epoch) * 100.0::double / 100, 6) as progress_percentage from ev where event = 'progress' group by run""",
)
def progress(spark, folder):
    ev = run_events(spark, folder).filter("event = 'progress'").withColumn("total_epochs", F.lit(100).cast("bigint"))
    out = runs.progress(ev)
    return out.withColumn("progress_percentage", F.round(F.col("progress_percentage").cast("double"), 6))


@query(
    "wn10_minute_series",
    """with p as (select event_type, date_trunc('minute', ts) as minute, value from events),
    f as (select event_type, minute, count(value) as n, avg(value) as mean_value from p group by all),
    s as (select event_type, unnest(generate_series(min(minute), max(minute), interval 1 minute)) as minute from p group by event_type)
    select event_type, strftime(minute, '%Y-%m-%d %H:%M') as minute, coalesce(n, 0) as n, round(coalesce(mean_value, 0), 6) as mean_value
    from s left join f using (event_type, minute)""",
)
def minute_series(spark, folder):
    rows = runs.minute_series(table(spark, folder, "events"), "event_type", "ts", "value")
    return rows.select(
        "event_type",
        F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"),
        "n",
        F.round("mean_value", 6).alias("mean_value"),
    )
