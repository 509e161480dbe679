"""Aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.arrays import remap_contiguous
from millrace.operators import catalog, runs, split
from millrace.operators.encode import remap_to_ranks, token_counts, value_ranks, words_of
from millrace.operators.integrity import directory_sizes
from millrace.operators.position import permuted_position
from millrace.queries.registry import RUN_EVENTS, joined, query, run_events, sql_tokens, table


@query(
    "ag1_token_counts",
    f"""with w as (select doc_id, i as ix, t[i + 1] as token from
      (select doc_id, t, unnest(range(len(t))) as i from (select doc_id, {sql_tokens('text')} as t from documents)))
    select token, count(*) as n, min(doc_id) as first_doc from w group by token""",
)
def count_tokens(spark, folder):
    counts = token_counts(words_of(table(spark, folder, "documents"), "text", ["doc_id"], store=False), ["doc_id"])
    return counts.select("token", "n", F.col("first.doc_id").alias("first_doc"))


@query(
    "ag2_distinct_classes",
    """select class_name, cast(row_number() over (order by class_name) - 1 as bigint) as class_index
       from (select distinct p_type as class_name from part)""",
)
def distinct_classes(spark, folder):
    return catalog.distinct_classes(table(spark, folder, "part"), "p_type")


@query(
    "ag3_directory_sizes",
    "select source as dataset_id, sum(n_chars)::bigint as size_bytes from documents group by rollup(source)",
)
def sizes(spark, folder):
    files = table(spark, folder, "documents").select(
        F.col("source").alias("dataset_id"), F.col("n_chars").alias("size_bytes")
    )
    return directory_sizes(files)


METRICS = f"""{RUN_EVENTS}, m as (select run, seq, ts, epoch, event as metric, value from ev
  where event in ('metric', 'progress'))"""


def _metrics(spark, folder):
    return run_events(spark, folder).filter("event in ('metric', 'progress')").withColumnRenamed(
        "event", "metric"
    )


@query(
    "ag4_epoch_summary",
    f"""with {METRICS} select run, epoch, metric, value from (
      select *, row_number() over (partition by run, epoch, metric order by ts desc, seq desc) as rn from m) where rn = 1""",
)
def epoch_summary(spark, folder):
    return runs.epoch_summary(_metrics(spark, folder), ["ts", "seq"])


@query(
    "ag5_metric_summary",
    f"""with {METRICS} select run, metric, count(value) as n, min(value) as min_value, max(value) as max_value,
      round(avg(value), 6) as mean_value, arg_min(value, seq) as first_value, arg_max(value, seq) as last_value
    from m group by run, metric""",
)
def metric_summary(spark, folder):
    rows = runs.metric_summary(_metrics(spark, folder), ["ts", "seq"])
    return rows.withColumn("mean_value", F.round("mean_value", 6))


@query(
    "ag6_row_value_set",
    """with q as (select vec_id, [cast(floor((e + 1) * 8) as bigint) for e in embedding] as v from embeddings),
    s as (select vec_id, v, list_sort(list_distinct(v)) as d from q)
    select vec_id, array_to_string(d, ' ') as value_set,
      array_to_string([list_position(d, x) - 1 for x in v], ' ') as remapped from s""",
)
def row_value_set(spark, folder):
    quantised = F.transform("embedding", lambda e: F.floor((e + 1) * 8))
    rows = table(spark, folder, "embeddings").select("vec_id", quantised.alias("v"))
    return rows.select(
        "vec_id",
        joined(F.array_sort(F.array_distinct("v"))).alias("value_set"),
        joined(remap_contiguous(F.col("v"))).alias("remapped"),
    )


@query(
    "ag6_global_value_set",
    """with q as (select vec_id, case vec_id % 10 when 3 then [] when 7 then null
        else [cast(floor((e + 1) * 8) as bigint) for e in embedding] end as v from embeddings),
    s as (select v, row_number() over (order by v) - 1 as r from (select distinct unnest(v) as v from q)),
    m as (select vec_id, sum(r)::bigint as rank_sum, max(r)::bigint as rank_max
      from (select vec_id, unnest(v) as v from q) join s using (v) group by vec_id)
    select vec_id, cast(len(v) as bigint) as n_values, rank_sum, rank_max from q left join m using (vec_id)""",
)
def global_values(spark, folder):
    quantised = F.transform("embedding", lambda e: F.floor((e + 1) * 8))
    # rows whose array is empty or null stay, too
    some = F.when(F.col("vec_id") % 10 == 3, F.array().cast("array<bigint>")).when(F.col("vec_id") % 10 != 7, quantised)
    rows = table(spark, folder, "embeddings").select("vec_id", some.alias("v"))
    ranks = remap_to_ranks(rows, "v", value_ranks(rows, "v"), ["vec_id"], "r")
    total = F.aggregate("r", F.lit(0).cast("bigint"), lambda n, r: n + r)
    return ranks.select(
        "vec_id",
        F.when(F.col("r").isNotNull(), F.size("r")).cast("bigint").alias("n_values"),
        F.when(F.size("r") > 0, total).alias("rank_sum"),
        F.array_max("r").alias("rank_max"),
    )


@query(
    "ag7_scorer_aggregates",
    """with s as (select lang, quality as actual, 1 - toxic as predicted from documents join labels using (doc_id)),
    c as (select lang, count(*) as n, count(*) filter (actual = 1 and predicted = 1) as tp,
      count(*) filter (actual = 0 and predicted = 1) as fp, count(*) filter (actual = 1 and predicted = 0) as fn,
      count(*) filter (actual = predicted) as hits from s group by lang)
    select lang, n, round(hits / n::double, 9) as accuracy,
      round(case when tp + fp > 0 then tp / (tp + fp)::double else 0 end, 9) as precision,
      round(case when tp + fn > 0 then tp / (tp + fn)::double else 0 end, 9) as recall,
      round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double else 0 end, 9) as f1 from c""",
)
def scorer_aggregates(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    scores = rows.select("lang", F.col("quality").alias("actual"), (1 - F.col("toxic")).alias("predicted"))
    out = catalog.scorer_aggregates(scores, ["lang"])
    return out.withColumns({c: F.round(c, 9) for c in ("accuracy", "precision", "recall", "f1")})


@query(
    "ag8_collect_batches",
    """with o as (select vec_id, label, list_sum([v::double for v in embedding]) as x,
                       row_number() over (order by md5('42:' || vec_id), vec_id) - 1 as pos from embeddings)
    select cast(pos // 32 as bigint) as batch_id, array_to_string(list(vec_id order by pos), ' ') as ids,
      array_to_string(list(label order by pos), ' ') as labels, round(sum(x), 5) as value_sum
    from o group by pos // 32""",
)
def collect_batches(spark, folder):
    rows = permuted_position(table(spark, folder, "embeddings"), ["vec_id"], 42)
    batches = split.collect_batches(split.assign_batches(rows, 32), ["vec_id", "embedding", "label"])
    total = F.aggregate(F.flatten("embedding"), F.lit(0.0), lambda a, v: a + v.cast("double"))
    return batches.select(
        "batch_id",
        joined(F.col("vec_id")).alias("ids"),
        joined(F.col("label")).alias("labels"),
        F.round(total, 5).alias("value_sum"),
    )


@query(
    "ag9_upload_accounting",
    f"""with {RUN_EVENTS} select run, count(distinct epoch) as accepted,
      cast(count(*) - count(distinct epoch) as bigint) as duplicates from ev group by run""",
)
def upload_accounting(spark, folder):
    return runs.upload_accounting(run_events(spark, folder), "run", "epoch")


@query(
    "ag10_ratings",
    """with r as (select o_custkey, avg(cast(substr(o_orderpriority, 1, 1) as int)) as mean_rating, count(*) as n
                  from orders where o_orderstatus <> 'F' group by o_custkey),
    s as (select o_custkey, count(*) as n from orders where o_orderstatus = 'F' group by o_custkey)
    select o_custkey, round(mean_rating, 9) as mean_rating, coalesce(r.n, 0) as n_reviews, coalesce(s.n, 0) as n_stars
    from r full join s using (o_custkey)""",
)
def ratings(spark, folder):
    orders = table(spark, folder, "orders")
    reviews = orders.filter("o_orderstatus <> 'F'").select(
        "o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rating")
    )
    stars = orders.filter("o_orderstatus = 'F'").select("o_custkey")
    return catalog.ratings(reviews, stars, "o_custkey").withColumn("mean_rating", F.round("mean_rating", 9))
