"""Writers: each query writes and returns what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.runs import run_state
from millrace.operators.split import ratio_split
from millrace.queries.registry import RUN_EVENTS, indexed, one_line_base64, query, run_events, table
from millrace.session import fresh_path
from millrace.sinks import events as event_sink
from millrace.sinks import manifest, shards


@query(
    "sk1_append_events",
    f"""with {RUN_EVENTS}
    select seq, event, epoch,
      case when event = 'progress' then '0' else '1' end as schema_version,
      cast(case when event = 'failed' then least(500, 7 * epoch) else 0 end as bigint) as summary_chars,
      cast(case when event = 'failed' then least(8192, 100 * epoch) else 0 end as bigint) as trace_chars
    from ev""",
)
def append_events(spark, folder):
    ev = run_events(spark, folder)
    failed = F.col("event") == "failed"
    rows = ev.select(
        "seq",
        "event",
        "epoch",
        F.when(F.col("event") == "progress", "0").alias("schema_version"),
        F.when(failed, F.repeat(F.lit("summary"), F.col("epoch").cast("int"))).alias("technical_summary"),
        F.when(failed, F.repeat(F.lit("t" * 100), F.col("epoch").cast("int"))).alias("traceback"),
    )
    path = fresh_path(spark, "events")
    event_sink.append_events(rows, path)
    back = spark.read.schema(rows.schema).json(path)
    return back.select(
        "seq",
        "event",
        "epoch",
        "schema_version",
        F.coalesce(F.length("technical_summary"), F.lit(0)).cast("bigint").alias("summary_chars"),
        F.coalesce(F.length("traceback"), F.lit(0)).cast("bigint").alias("trace_chars"),
    )


@query(
    "sk2_deliver_batches",
    f"""with {RUN_EVENTS},
    k as (select run, seq, row_number() over (partition by run order by seq) - 1 as pos from ev)
    select run, seq, cast(pos // 20 as bigint) as batch_id from k""",
)
def deliver_batches(spark, folder):
    ev = run_events(spark, folder).select("run", "seq", F.concat_ws(":", "run", "seq").alias("event_id"))
    path = fresh_path(spark, "delivered")
    # every event is sent twice, as after a lost answer
    event_sink.deliver_batches(ev.unionByName(ev), path, batch_size=20)
    return spark.read.parquet(path).select("run", "seq", "batch_id")


@query(
    "sk3_write_training_shards",
    """with li as (select row_number() over () - 1 as row_index, * from lineitem),
    o as (select *, row_number() over (order by md5('42:' || row_index), row_index) - 1 as p,
                 count(*) over () as n from li),
    s as (select *, case when p < n - cast(floor(n * 0.1::double) as bigint) * 2 then 'train'
                         when p < n - cast(floor(n * 0.1::double) as bigint) then 'val' else 'test' end as split from o),
    q as (select *, row_number() over (partition by split order by md5('42:0:' || row_index), row_index) - 1 as pos from s)
    select split, cast(pos // 256 as bigint) as batch_id, count(*) as n_rows, sum(row_index)::bigint as index_sum,
           round(sum(l_quantity), 4) as quantity from q group by all""",
)
def write_training_shards(spark, folder):
    rows = ratio_split(indexed(spark, folder, "lineitem"), ["row_index"]).select(
        "split", "row_index", "l_quantity"
    )
    path = fresh_path(spark, "shards")
    shards.write_ordered_shards(rows, path, ["row_index"], "42:0", rows_per_shard=1 << 16)
    stored = shards.read_ordered_shards(spark, path, 256)
    return stored.groupBy("split", "batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("row_index").alias("index_sum"),
        F.round(F.sum("l_quantity"), 4).alias("quantity"),
    )


@query(
    "sk4_write_manifest",
    """select doc_id || '.txt' as file, cast(octet_length(encode(text)) as bigint) as size_bytes,
              sha256(text) as checksum from documents""",
)
def write_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    files = docs.select(
        F.concat(F.col("doc_id"), F.lit(".txt")).alias("file"), F.col("text").cast("binary").alias("content")
    )
    expected = docs.select(
        F.concat(F.col("doc_id"), F.lit(".txt")).alias("file"),
        F.concat(F.lit("sha256:"), F.sha2(F.col("text").cast("binary"), 256)).alias("checksum"),
    )
    stored = manifest.write_manifest(files, fresh_path(spark, "manifest"), expected)
    return stored.select("file", "size_bytes", "checksum")


@query(
    "sk5_upsert_run_state",
    f"""with {RUN_EVENTS},
    r as (select *, row_number() over (partition by run order by ts desc, seq desc) as rn from ev)
    select run, epoch, seq as step, 'ckpt/' || seq || '.pt' as latest_checkpoint_path,
           case when event = 'complete' then 'c' || seq end as latest_checkpoint_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') as last_update
    from r where rn = 1""",
)
def upsert_run_state(spark, folder):
    ev = run_events(spark, folder).select(
        "run",
        "epoch",
        F.col("seq").alias("step"),
        F.concat(F.lit("ckpt/"), F.col("seq"), F.lit(".pt")).alias("latest_checkpoint_path"),
        F.when(F.col("event") == "complete", F.concat(F.lit("c"), F.col("seq"))).alias("latest_checkpoint_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("last_update"),
        "ts",
        "seq",
    )
    return run_state(ev, ["ts", "seq"])


@query(
    "sk6_extract_preview_media",
    r"""with c as (select doc_id, lang, case lang
        when 'en' then to_base64('\x89PNG\x0D\x0A\x1A\x0A'::blob || encode(text))
        when 'de' then 'data:image/gif;base64,' || to_base64('GIF89a'::blob || encode(text))
        when 'es' then to_base64(encode(text)) else text end as cell,
        case lang when 'en' then '\x89PNG\x0D\x0A\x1A\x0A'::blob || encode(text)
                  when 'de' then 'GIF89a'::blob || encode(text) end as raw,
        case lang when 'en' then 'png' when 'de' then 'gif' end as ext from documents)
    select doc_id, case when ext is null or doc_id % 5 = 0 then md5(cell)
        else 'my_set-sample' || doc_id || '-cell.' || ext end as cell, case when doc_id % 5 <> 0 then sha256(raw) end as image,
      case when lang not in ('en', 'de', 'es') then 'not base64' when doc_id % 5 = 0 and lang <> 'es' then 'too long'
           when lang = 'es' then case when doc_id % 5 = 0 then 'too long' else 'no image' end end as refused from c""",
)
def extract_preview_media(spark, folder):
    docs = table(spark, folder, "documents")
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A")), F.col("text").cast("binary"))
    gif = F.concat(F.lit("GIF89a").cast("binary"), F.col("text").cast("binary"))
    cell = (
        F.when(F.col("lang") == "en", one_line_base64(png))
        .when(F.col("lang") == "de", F.concat(F.lit("data:image/gif;base64,"), one_line_base64(gif)))
        .when(F.col("lang") == "es", one_line_base64(F.col("text").cast("binary")))
        .otherwise(F.col("text"))
    )
    samples = docs.select("doc_id", cell.alias("cell"))
    # every fifth cell meets a limit that it exceeds, the others meet none
    short, free = samples.filter("doc_id % 5 = 0"), samples.filter("doc_id % 5 <> 0")
    out = manifest.extract_preview_media(short, "my set", "cell", "doc_id", most=4).unionByName(
        manifest.extract_preview_media(free, "my set", "cell", "doc_id", most=None)
    )
    return out.select(
        "doc_id",
        "refused",
        F.when(F.col("content").isNull(), F.md5("cell")).otherwise(F.col("cell")).alias("cell"),
        F.sha2("content", 256).alias("image"),
    )
