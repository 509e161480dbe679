"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays, labels, records, text
from millrace.operators import roles, runs
from millrace.operators.catalog import name_collisions
from millrace.operators.encode import encode_labels, encode_target
from millrace.queries.registry import RUN_EVENTS, joined, one_line_base64, query, run_events, sql_crc, sql_tokens, table
from millrace.session import spread


def _hash_sql(source: str, key: str, maxlen: int, words: int) -> str:
    return f"""with d as (select {key}, {sql_tokens('text')}[1:{maxlen}] as t from {source}),
    w as (select {key}, i, t[i + 1] as token from (select *, unnest(range(len(t))) as i from d)),
    {sql_crc('w')},
    h as (select {key}, list(cast(h % {words - 1} + 1 as bigint) order by i) as ids from w join crc using (token) group by all)
    select {key}, array_to_string(coalesce(ids, []::bigint[]) || [0::bigint for j in range({maxlen} - coalesce(len(ids), 0))], ' ') as ids
    from d left join h using ({key})"""


@query("fn1_hash_tokenize", _hash_sql("documents", "doc_id", 200, 20000))
def hash_tokenize(spark, folder):
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", joined(text.hash_tokens(F.col("text"))).alias("ids"))


@query("fn1_hash_tokenize_turns", _hash_sql("conversations", "conv_id, turn", 64, 1000))
def hash_tokenize_turns(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", joined(text.hash_tokens(F.col("text"), 64, 1000)).alias("ids"))


@query("fn2_tokenize_column", _hash_sql("documents", "doc_id", 32, 5000))
def tokenize_column(spark, folder):
    docs = table(spark, folder, "documents")
    binding = {
        "input_column": "text",
        "input_transform": {"kind": "tokenize", "params": {"sequence_length": 32, "vocab_size": 5000}},
    }
    _, features = roles.split_by_roles(docs.columns, {"text": "text_input", "lang": "target"})
    return docs.select("doc_id", joined(roles.feature_column(docs, features, binding)).alias("ids"))


@query(
    "fn3_encode_label",
    """select vec_id, cast(case label when 0 then 9 else label - 1 end as bigint) as code from embeddings""",
)
def encode_label(spark, folder):
    # integer labels match text names
    names = [str(i) for i in [*range(1, 10), 0]]
    return encode_labels(table(spark, folder, "embeddings").select("vec_id", "label"), "label", names).select(
        "vec_id", "code"
    )


@query("fn3_encode_label_bool", "select doc_id, cast(case when quality = 1 then 0 else 1 end as bigint) as code from labels")
def encode_label_bool(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    return encode_labels(rows, "good", ["True", "False"]).select("doc_id", "code")


@query(
    "fn4_encode_target",
    """select l_orderkey, l_linenumber, cast(cast(l_extendedprice as float) as double) as target, cast(1 as bigint) as width from lineitem""",
)
def numeric_target(spark, folder):
    rows = encode_target(table(spark, folder, "lineitem"), "l_extendedprice", kind="numeric")
    return rows.select(
        "l_orderkey", "l_linenumber",
        F.get("target", F.lit(0)).cast("double").alias("target"),
        F.size("target").cast("bigint").alias("width"),
    )


# word lengths of a text stand for its token ids
LENGTHS = f"select doc_id, [cast(length(w) as bigint) for w in {sql_tokens('text')}] as ids from documents"


def _lengths(spark, folder):
    words = text.tokens(F.col("text"))
    ids = F.transform(words, lambda w: F.length(w).cast("bigint"))
    return table(spark, folder, "documents").select("doc_id", ids.alias("ids"))


@query(
    "fn5_pad_sequences",
    f"""with s as ({LENGTHS}), p as (select doc_id, [case when i < 9 then i else 0 end for i in ids[1:200]] as k from s)
    select doc_id, array_to_string(k || [0::bigint for j in range(200 - len(k))], ' ') as ids from p""",
)
def pad_sequences(spark, folder):
    rows = _lengths(spark, folder)
    return rows.select("doc_id", joined(arrays.pad_sequences(F.col("ids"), 200, 9)).alias("ids"))


QUANTISED = "select vec_id, [cast(floor((e + 1) * 8) as bigint) for e in embedding] as v from embeddings"


def _quantised(spark, folder):
    value = F.transform("embedding", lambda e: F.floor((e + 1) * 8))
    return table(spark, folder, "embeddings").select("vec_id", value.alias("v"))


@query(
    "fn6_clamp_token_ids",
    f"with q as ({QUANTISED}) select vec_id, array_to_string([case when x < 9 then x else 0 end for x in v], ' ') as ids from q",
)
def clamp_token_ids(spark, folder):
    return _quantised(spark, folder).select("vec_id", joined(arrays.clamp_token_ids(F.col("v"), 9)).alias("ids"))


@query(
    "fn7_clip_token_ids",
    f"""with q as ({QUANTISED}) select vec_id,
      array_to_string([least(greatest(x, 0), 8) for x in v[1:50]], ' ') as cut,
      array_to_string([least(greatest(x, 0), 8) for x in v || [0::bigint for j in range(16)]], ' ') as padded from q""",
)
def clip_token_ids(spark, folder):
    return _quantised(spark, folder).select(
        "vec_id",
        joined(arrays.clip_token_ids(F.col("v"), 50, 9)).alias("cut"),
        joined(arrays.clip_token_ids(F.col("v"), 80, 9)).alias("padded"),
    )


@query(
    "fn8_casts",
    """select vec_id, cast(label as bigint) as class_index, cast(cast(label as float) as double) as numeric_value,
      round(list_sum([v::double for v in embedding]), 6) as same from embeddings""",
)
def casts(spark, folder):
    from millrace.plans.prepare import transform_column

    label = F.col("label")
    same = transform_column(F.col("embedding"), None)
    return table(spark, folder, "embeddings").select(
        "vec_id",
        transform_column(label, {"kind": "class_index"}).alias("class_index"),
        transform_column(label, {"kind": "numeric"}).cast("double").alias("numeric_value"),
        F.round(F.aggregate(same, F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("same"),
    )


@query(
    "fn9_fit_length",
    """select vec_id, i as at, cast(coalesce(embedding[i + 1], 0) as double) as v, cast(64 as bigint) as unchanged
       from (select *, unnest(range(80)) as i from embeddings)""",
)
def fit_length(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        F.posexplode(arrays.fit_length(F.col("embedding"), 80)).alias("at", "v"),
        F.size(arrays.fit_length(F.col("embedding"), True)).cast("bigint").alias("unchanged"),
    )
    return rows.select("vec_id", F.col("at").cast("bigint").alias("at"), F.col("v").cast("double").alias("v"), "unchanged")


@query(
    "fn10_normalize",
    """select vec_id, i as at, cast(cast((embedding[i + 1] - cast([0.1, 0.2, 0.3, 0.4][i % 4 + 1] as float))::double
        / [0.5, 0.25, 2, 4][i % 4 + 1]::double as float) as double) as v,
      cast(cast(embedding[i + 1]::double / 255 as float) as double) as scaled
    from (select *, unnest(range(64)) as i from embeddings)""",
)
def normalize(spark, folder):
    value = F.col("embedding")
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        arrays.normalize(value, [0.1, 0.2, 0.3, 0.4], [0.5, 0.25, 2, 4]).alias("n"),
        arrays.rescale(value).alias("s"),
    )
    values = rows.select("vec_id", F.posexplode("n").alias("at", "v"), "s")
    return values.select(
        "vec_id",
        F.col("at").cast("bigint").alias("at"),
        F.col("v").cast("double").alias("v"),
        F.get("s", "at").cast("double").alias("scaled"),
    )


@query(
    "fn11_remap_contiguous",
    f"""with q as ({QUANTISED}) select vec_id,
      array_to_string([coalesce(list_position([4, 6, 7, 9, 11], x), 1) - 1 for x in v], ' ') as remapped from q""",
)
def remap_contiguous(spark, folder):
    rows = _quantised(spark, folder)
    return rows.select("vec_id", joined(arrays.remap_contiguous(F.col("v"), [9, 7, 4, 6, 11])).alias("remapped"))


@query(
    "fn12_mean_channels",
    """select vec_id, i as at, cast(cast((embedding[2 * i + 1]::double + embedding[2 * i + 2]::double) / 2 as float) as double) as v
       from (select *, unnest(range(32)) as i from embeddings)""",
)
def mean_channels(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.posexplode(arrays.mean_channels(F.col("embedding"), 2)).alias("at", "v")
    )
    return rows.select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.col("v").cast("double").alias("v")
    )


@query(
    "fn13_column_kind",
    f"""with d as (select min(len(t)) <> max(len(t)) as p from (select {sql_tokens('text')} as t from documents)),
    e as (select min(len(embedding)) <> max(len(embedding)) as p from embeddings)
    select 'documents.words' as "column", true as is_text, p as needs_padding from d
    union all select 'embeddings.embedding', false, p from e""",
)
def column_kind(spark, folder):
    docs = table(spark, folder, "documents").select("text", text.tokens(F.col("text")).alias("words"))
    vectors = table(spark, folder, "embeddings")

    def row(name, is_text, answer):
        return answer.select(F.lit(name).alias("column"), F.lit(is_text).alias("is_text"), "needs_padding")

    return row("documents.words", roles.is_text(docs, "text"), roles.needs_padding(docs, "words")).unionByName(
        row("embeddings.embedding", roles.is_text(vectors, "embedding"), roles.needs_padding(vectors, "embedding"))
    )


@query(
    "fn14_json_values",
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_type in ('click', 'purchase') as is_object,
      case event_type when 'view' then '[' || props || ']' when 'error' then props || ' x' when 'signup' then 'k ' || props end as raw,
      try_cast(case when event_type = 'view' then 'soon' else cast(json_extract_string(props, '$.k') as varchar) end as int) as retry
    from events""",
)
def json_values(spark, folder):
    kind, props = F.col("event_type"), F.col("props")
    given = (
        F.when(kind == "view", F.concat(F.lit("["), props, F.lit("]")))
        .when(kind == "error", F.concat(props, F.lit(" x")))
        .when(kind == "signup", F.concat(F.lit("k "), props))
        .otherwise(props)
    )
    parsed = records.json_or_text(given)
    k = F.get_json_object(props, "$.k")
    rows = table(spark, folder, "events").select(
        "event_id", k.cast("bigint").alias("k"), parsed.alias("p"),
        records.retry_or_null(F.when(kind == "view", "soon").otherwise(k)).alias("retry"),
    )
    return rows.select("event_id", "k", F.col("p.object").isNotNull().alias("is_object"), F.col("p.text").alias("raw"), "retry")


@query(
    "fn15_explode_metrics",
    f"""with {RUN_EVENTS} select run, seq, unnest(['loss', 'epoch', 'half']) as metric,
      unnest([value, epoch::double, value / 2]) as value from ev where event = 'metric'""",
)
def explode_metrics(spark, folder):
    ev = run_events(spark, folder).filter("event = 'metric'")
    metrics = F.create_map(
        F.lit("loss"), F.col("value"), F.lit("epoch"), F.col("epoch").cast("double"), F.lit("half"), F.col("value") / 2
    )
    return runs.explode_metrics(ev.select("run", "seq", metrics.alias("metrics")))


@query(
    "fn16_timestamps",
    """select event_id, case event_type when 'click' then strftime(ts, '%Y-%m-%d')
        when 'view' then strftime(ts, '%Y-%m-%d') when 'signup' then strftime(ts - interval 5 hour, '%Y-%m-%d')
        when 'error' then 'not a day' else '-' end as day,
      case when event_type in ('click', 'view') then epoch(date_trunc('second', ts))::bigint
           when event_type = 'signup' then epoch(date_trunc('second', ts) - interval 5 hour)::bigint end as second
    from events""",
)
def timestamps(spark, folder):
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_type")
    given = (
        F.when(kind == "click", ts)
        .when(kind == "view", F.concat(ts, F.lit("Z")))
        .when(kind == "signup", F.concat(ts, F.lit("+05:00")))
        .when(kind == "error", F.lit("not a dayT12"))
    )
    rows = table(spark, folder, "events").select("event_id", given.alias("t"))
    return rows.select(
        "event_id",
        records.format_day(F.col("t")).alias("day"),
        F.unix_seconds(records.parse_timestamp(F.col("t"))).alias("second"),
    )


@query(
    "fn17_redact",
    r"""select event_id, case event_type
        when 'click' then 'GET https://api.test/x?a=1&X-Amz-Signature=<redacted>&b=' || event_id
        when 'view' then 'retry ?token=<redacted> later'
        when 'error' then 'Authorization: <redacted>'
        when 'signup' then '{"x-api-key": <redacted>' else 'user ' || user_id end as message,
      case when event_type = 'click' then '<redacted>' end as download_url from events""",
)
def redact(spark, folder):
    events = table(spark, folder, "events")
    secret = F.md5(F.col("event_id").cast("string"))
    kind = F.col("event_type")
    line = (
        F.when(kind == "click", F.concat(F.lit("GET https://api.test/x?a=1&X-Amz-Signature="), secret, F.lit("&b="), "event_id"))
        .when(kind == "view", F.concat(F.lit("retry ?token="), secret, F.lit(" later")))
        .when(kind == "error", F.concat(F.lit("Authorization: Bearer sk "), secret))
        .when(kind == "signup", F.concat(F.lit('{"x-api-key": "'), secret, F.lit('", "a": 1}')))
        .otherwise(F.concat(F.lit("user "), F.col("user_id")))
    )
    url = F.when(kind == "click", F.concat(F.lit("https://files.test/"), secret))
    return events.select("event_id", text.redact(line).alias("message"), text.redact_url(url).alias("download_url"))


@query(
    "fn17_redact_error",
    r"""select event_id, case event_type
        when 'click' then 'error at ''stream_token=<redacted>'' again' when 'view' then 'X-Amz-Signature=<redacted>&b=' || event_id
        when 'error' then 'get "https://h/x?a=1&sig=<redacted>" failed' else 'user=' || user_id end as message from events""",
)
def redact_error(spark, folder):
    events = table(spark, folder, "events")
    secret, kind = F.md5(F.col("event_id").cast("string")), F.col("event_type")
    line = (
        F.when(kind == "click", F.concat(F.lit("error at 'stream_token="), secret, F.lit("' again")))
        .when(kind == "view", F.concat(F.lit("X-Amz-Signature="), secret, F.lit("&b="), F.col("event_id")))
        .when(kind == "error", F.concat(F.lit('get "https://h/x?a=1&sig='), secret, F.lit('" failed')))
        .otherwise(F.concat(F.lit("user="), F.col("user_id")))
    )
    return events.select("event_id", text.redact_error(line).alias("message"))


@query(
    "fn18_clean_text",
    r"""with c as (select doc_id, regexp_replace(text, '[\x00-\x08\x0b-\x1f\x{7f}-\x{9f}]', '', 'g') as t from documents)
    select doc_id, md5(t) as cleaned, case when length(t) <= 40 then t else substr(t, 1, 37) || '...' end as short,
      'a' || doc_id || '[31mb' as escaped from c""",
)
def clean_text(spark, folder):
    docs = table(spark, folder, "documents")
    escape = F.concat(F.lit("a"), F.col("doc_id"), F.lit("\x1b[31m\x9bb\x07"))
    return docs.select(
        "doc_id",
        F.md5(text.strip_control(F.col("text"))).alias("cleaned"),
        text.truncate(F.col("text"), 40).alias("short"),
        text.strip_control(escape).alias("escaped"),
    )


@query(
    "fn20_file_names",
    r"""with u as (select page_id, regexp_replace(url, '[?#].*$', '') as p from pages),
    n as (select page_id, regexp_extract(regexp_replace(p, '/+$', ''), '([^/]*)$', 1) as last from u),
    m as (select page_id, regexp_extract(last, '([^:]*)$', 1) as name from n),
    k as (select page_id, case when name in ('', '.', '..') then 'page' else name end as name from m)
    select page_id, name, count(*) over (partition by name) as sharing,
      case when page_id % 2 = 0 then name else 'a;b ' || page_id end as header_name,
      regexp_replace(regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') as component from k""",
)
def file_names(spark, folder):
    bare = F.regexp_replace("url", r"[?#].*$", "")
    named = table(spark, folder, "pages").select(
        "page_id", text.safe_basename(bare, F.lit("page")).alias("name")
    )
    even = F.col("page_id") % 2 == 0
    header = F.when(even, F.concat(F.lit("attachment; filename="), "name", F.lit("; size=3"))).otherwise(
        F.concat(F.lit('attachment; filename="a;b '), "page_id", F.lit('"'))
    )
    return name_collisions(named).select(
        "page_id", "name", "sharing",
        text.disposition_filename(header).alias("header_name"),
        text.safe_component(F.col("name")).alias("component"),
    )


@query(
    "fn22_artifact_type",
    """select p_partkey, case p_type when 'PROMO' then 'adapter' when 'ECONOMY' then 'tokenizer' when 'LARGE' then 'architecture_config'
        when 'SMALL' then 'readme' else 'weights' end as kind,
      case p_type when 'PROMO' then 'adapter_config.json' when 'ECONOMY' then 'tokenizer.json' when 'LARGE' then 'config.json'
        when 'SMALL' then 'README.md' when 'MEDIUM' then 'model-' || p_partkey || '.bin' else p_partkey || '.bin' end as file_name
    from part""",
)
def artifact_type(spark, folder):
    kind, key = F.col("p_type"), F.col("p_partkey").cast("string")
    filename = (
        F.when(kind == "PROMO", "adapter_config.json").when(kind == "ECONOMY", "tokenizer.json")
    )
    logical = (
        F.when(kind == "LARGE", "hub/config.json")
        .when(kind == "SMALL", "../README.md")
        .when(kind == "MEDIUM", F.concat(F.lit("weights\\model-"), key, F.lit(".bin")))
    )
    # an empty name counts as none
    name = records.artifact_name(F.coalesce(filename, F.lit("")), logical, key)
    return table(spark, folder, "part").select(
        "p_partkey", records.artifact_type(name).alias("kind"), name.alias("file_name")
    )


@query(
    "fn23_sniff_image",
    r"""select doc_id, case doc_id % 7 when 0 then 'png' when 1 then 'jpg' when 2 then 'gif' when 3 then 'bmp' when 4 then 'webp' end as kind,
      doc_id % 7 <> 6 as decoded from documents""",
)
def sniff_image(spark, folder):
    heads = ["89504E470D0A1A0A", "FFD8FFE0", "474946383761", "424D", "524946460000000057454250", "00"]
    part = (F.col("doc_id") % 7).cast("int")
    body = F.concat(F.unhex(F.get(F.lit(heads), part)), F.col("text").cast("binary"))
    # the last kind is no base64
    cell = F.when(part == 6, F.concat(F.lit("!"), one_line_base64(F.col("text").cast("binary")))).otherwise(one_line_base64(body))
    raw = records.image_bytes(cell)
    return table(spark, folder, "documents").select(
        "doc_id", records.sniff_image(raw).alias("kind"), raw.isNotNull().alias("decoded")
    )


@query("fn25_sha256", "select doc_id, sha256(text) as checksum, true as holds from documents")
def sha256(spark, folder):
    digest = records.checksum(F.col("text").cast("binary"))
    stored = F.concat(F.lit("sha256:"), digest)
    return table(spark, folder, "documents").select(
        "doc_id", digest.alias("checksum"), (records.bare_checksum(stored) == digest).alias("holds")
    )


@query(
    "fn26_event_id",
    f"""with {RUN_EVENTS} select run, seq, case when event = 'metric' then 'own-' || seq else run || ':' || seq * 10 end as event_id from ev""",
)
def event_id(spark, folder):
    own = F.when(F.col("event") == "metric", F.concat(F.lit("own-"), "seq"))
    return run_events(spark, folder).select(
        "run", "seq", records.event_id(own, F.col("run"), F.col("seq") * 10).alias("event_id")
    )


@query(
    "fn27_shape_target",
    """select l_orderkey, cast(l_linenumber as bigint) as code, cast(cast(l_tax as float) as double) as value,
        cast(1 as bigint) as width from lineitem""",
)
def shape_target(spark, folder):
    rows = table(spark, folder, "lineitem")
    whole = labels.shape_target(F.col("l_linenumber"), rows.schema["l_linenumber"].dataType)
    real = labels.shape_target(F.col("l_tax"), rows.schema["l_tax"].dataType)
    return rows.select("l_orderkey", whole.alias("code"), real.alias("r")).select(
        "l_orderkey", "code",
        F.get("r", F.lit(0)).cast("double").alias("value"),
        F.size("r").cast("bigint").alias("width"),
    )
