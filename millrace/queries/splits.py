"""Splits, shuffles, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import split
from millrace.operators.position import permuted_position
from millrace.queries.registry import LINEITEM, indexed, joined, query, table


@query(
    "sp1_ratio_split",
    """with o as (select doc_id, row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as p,
                       count(*) over () as n from documents)
    select doc_id, case when p < n - 2 * cast(floor(n * 0.1::double) as bigint) then 'train'
      when p < n - cast(floor(n * 0.1::double) as bigint) then 'val' else 'test' end as split from o""",
)
def ratio_split(spark, folder):
    return split.ratio_split(table(spark, folder, "documents").select("doc_id"), ["doc_id"])


@query(
    "sp1_ratio_split_two_keys",
    """with o as (select conv_id, turn, row_number() over
                  (order by md5('7:' || conv_id || ':' || turn), conv_id, turn) - 1 as p,
                       count(*) over () as n from conversations)
    select conv_id, turn,
      case when p < n - cast(floor(n * 0.25::double) as bigint) - cast(floor(n * 0.05::double) as bigint) then 'train'
      when p < n - cast(floor(n * 0.05::double) as bigint) then 'val' else 'test' end as split from o""",
)
def ratio_split_two_keys(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn")
    return split.ratio_split(rows, ["conv_id", "turn"], 0.25, 0.05, 7)


MEMBERS = """
m as (select case o_orderstatus when 'F' then 'train' else 'eval_holdout' end as split_name,
             o_orderkey as pos, 5 * o_orderkey as row_index from orders)
"""


def _membership(spark, folder):
    return table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "train").otherwise("eval_holdout").alias("split_name"),
        F.col("o_orderkey").alias("pos"),
        (F.col("o_orderkey") * 5).alias("row_index"),
    )


@query(
    "sp2_membership_split",
    f"""with {LINEITEM}, {MEMBERS} select cast(row_index as bigint) as row_index, pos, l_orderkey, l_quantity
    from m join li using (row_index) where split_name = 'eval_holdout'""",
)
def membership_split(spark, folder):
    rows = indexed(spark, folder, "lineitem").select("row_index", "l_orderkey", "l_quantity")
    return split.membership_split(rows, _membership(spark, folder), "val")


@query(
    "sp2_membership_fallback",
    """with o as (select doc_id, row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as p,
                       count(*) over () as n from documents)
    select doc_id, cast(row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as bigint) as pos
    from o where p >= n - cast(floor(n * 0.1::double) as bigint)""",
)
def membership_fallback(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    nothing = _membership(spark, folder).filter("split_name = 'none'")
    return split.membership_split(docs, nothing, "test", ["doc_id"])


@query(
    "sp2_parse_membership",
    """select cast(doc_id // 100 as bigint) as dataset_id, 'fold_' || lang as split_name,
        cast(row_number() over (partition by doc_id // 100, lang order by doc_id) - 1 as bigint) as pos,
        doc_id as row_index from documents where lang <> 'es'""",
)
def parse_membership(spark, folder):
    # one dataset per hundred documents
    docs = table(spark, folder, "documents").withColumn("dataset_id", F.expr("doc_id div 100"))
    # entries of other types stand between the indices; the es split has no list
    members = F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda d: d.cast("string")), ',"x",true,1.5,')
    per = docs.groupBy("dataset_id", "lang").agg(members.alias("ids"))
    entry = F.concat(
        F.lit('{"split_name":"fold_'), F.col("lang"), F.lit('","member_row_indices":'),
        F.when(F.col("lang") == "es", "null").otherwise(F.concat(F.lit("["), F.col("ids"), F.lit("]"))),
        F.lit("}"),
    )
    entries = per.groupBy("dataset_id").agg(F.array_join(F.collect_list(entry), ",").alias("all"))
    meta = F.concat(F.lit('{"splits":[0,{"split_name":3,"member_row_indices":[1]},'), F.col("all"), F.lit("]}"))
    parsed = split.parse_membership(entries.select("dataset_id", meta.alias("meta")))
    return parsed.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "sp3_resolve_split_alias",
    """with d as (select distinct source, cast(substr(source, 4) as bigint) % 4 as kind from documents),
    r as (select unnest(['train', 'val', 'test', 'validation', 'holdout']) as requested)
    select source as dataset_id, requested,
      case kind
        when 0 then case requested when 'train' then 'train' when 'val' then 'eval_holdout'
          when 'test' then 'eval_holdout' when 'validation' then 'eval_holdout' end
        when 1 then case requested when 'train' then 'training' when 'val' then 'validation'
          when 'test' then 'dev' when 'validation' then 'validation' end
        when 2 then case requested when 'val' then 'val' when 'test' then 'test' when 'validation' then 'val' end
        else case requested when 'holdout' then 'holdout' end end as resolved
    from d, r""",
)
def resolve_split_alias(spark, folder):
    sources = table(spark, folder, "documents").select("source").distinct()
    kind = (F.substring("source", 4, 9).cast("bigint") % 4).cast("int")
    names = F.array(
        F.array(F.lit("train"), F.lit("eval_holdout")),
        F.array(F.lit("training"), F.lit("dev"), F.lit("validation")),
        F.array(F.lit("val"), F.lit("test")),
        F.array(F.lit("holdout")),
    )
    declared = sources.select(
        F.col("source").alias("dataset_id"), F.explode(F.get(names, kind)).alias("split_name")
    )
    asked = F.array(*[F.lit(n) for n in ("train", "val", "test", "validation", "holdout")])
    requests = sources.select(F.col("source").alias("dataset_id"), F.explode(asked).alias("requested"))
    return split.resolve_split_alias(declared, requests)


@query(
    "sp4_tail_holdout",
    """with o as (select vec_id, row_number() over (order by vec_id) - 1 as p, count(*) over () as n from embeddings)
    select vec_id, case when p >= n - cast(floor(n * 0.15::double) as bigint) then 'val' else 'train' end as split from o""",
)
def tail_holdout(spark, folder):
    return split.tail_holdout(table(spark, folder, "embeddings").select("vec_id"), "vec_id", 0.15)


@query(
    "sp5_head_holdout",
    """with o as (select vec_id, row_number() over (order by vec_id) - 1 as p, count(*) over () as n from embeddings)
    select vec_id, case when p < greatest(1, cast(floor(n * 0.15::double) as bigint)) then 'val' else 'train' end as split from o""",
)
def head_holdout(spark, folder):
    return split.head_holdout(table(spark, folder, "embeddings").select("vec_id"), "vec_id", 0.15)


@query(
    "sp6_permuted_holdout",
    """with o as (select vec_id, row_number() over (order by md5('42:' || vec_id), vec_id) - 1 as p,
                       count(*) over () as n from embeddings)
    select vec_id, case when p < cast(floor(n * 0.1::double) as bigint) then 'val' else 'train' end as split from o""",
)
def permuted_holdout(spark, folder):
    return split.permuted_holdout(table(spark, folder, "embeddings").select("vec_id"), ["vec_id"], 0.1)


@query(
    "sp7_audit_splits",
    f"""with {LINEITEM}, n as (select count(*) as n from lineitem), a as (
      select 'train' as split_name, row_index from li where l_returnflag in ('A', 'R')
      union all select 'val', row_index from li where l_linestatus = 'F' and l_tax < 0.03
      union all select 'test', row_index + n.n - 1000 from li, n where l_quantity = 7),
    i as (select distinct split_name, row_index from a),
    g as (select i.* from i, n where row_index between 0 and n.n - 1)
    select 'overlap' as kind, x.split_name || '|' || y.split_name as detail, count(*) as n
      from g x join g y on x.row_index = y.row_index and x.split_name < y.split_name group by all
    union all select 'uncovered', '', (select n from n) - count(distinct row_index) from g
    union all select 'out_of_range', split_name, count(*) from i, n
      where not row_index between 0 and n.n - 1 group by all""",
)
def audit_splits(spark, folder):
    rows = indexed(spark, folder, "lineitem")
    n = rows.count()

    def part(name, condition, index="row_index"):
        return rows.filter(condition).select(F.lit(name).alias("split_name"), F.expr(index).alias("row_index"))

    assigned = (
        part("train", "l_returnflag in ('A', 'R')")
        .unionByName(part("val", "l_linestatus = 'F' and l_tax < 0.03"))
        .unionByName(part("test", "l_quantity = 7", f"row_index + {n} - 1000"))
    )
    return split.audit_splits(assigned, n)


@query(
    "sp8_seeded_shuffle",
    """select o_orderkey, cast(row_number() over (order by md5('42:3:' || o_orderkey), o_orderkey) - 1 as bigint) as pos
       from orders""",
)
def seeded_shuffle(spark, folder):
    return split.seeded_shuffle(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 42, 3)


@query(
    "sp8_unshuffled",
    "select o_orderkey, cast(row_number() over (order by o_orderkey) - 1 as bigint) as pos from orders",
)
def unshuffled(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return split.seeded_shuffle(orders, ["o_orderkey"], split="val")


@query(
    "sp9_assign_batches",
    f"""with {LINEITEM}, o as (select row_index, row_number() over (order by md5('42:' || row_index), row_index) - 1 as pos,
                                       count(*) over () as n from li)
    select cast(row_index as bigint) as row_index, cast(pos // 77 as bigint) as batch_id,
           cast(pos % 77 as bigint) as pos_in_batch from o where pos // 77 < n // 77""",
)
def assign_batches(spark, folder):
    rows = indexed(spark, folder, "lineitem").select("row_index")
    placed = permuted_position(rows, ["row_index"], 42)
    batches = split.assign_batches(placed, 77, drop_last=True, total=rows.count())
    return batches.select("row_index", "batch_id", F.col("pos_in_batch").cast("bigint").alias("pos_in_batch"))


@query(
    "sp10_preview",
    """select c_custkey, c_name, c_acctbal from customer order by c_custkey limit 100""",
)
def preview(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return split.preview(rows, 1000, "c_custkey")


@query(
    "sp10_preview_statistics",
    """select 'c_acctbal' as "column", count(c_acctbal) as n, count(*) - count(c_acctbal) as nulls,
        min(c_acctbal) as min, max(c_acctbal) as max, round(avg(c_acctbal), 6) as mean from customer
       union all
       select 'c_nationkey', count(c_nationkey), count(*) - count(c_nationkey), min(c_nationkey)::double,
        max(c_nationkey)::double, round(avg(c_nationkey), 6) from customer""",
)
def preview_statistics(spark, folder):
    stats = split.preview_statistics(table(spark, folder, "customer"), ["c_acctbal", "c_nationkey"])
    return stats.withColumn("mean", F.round("mean", 6))


@query(
    "sp11_rebatch",
    """with s as (select vec_id // 7 as k, vec_id % 7 as i, label,
        [cast(floor((embedding[j + 1] + 1) * 8) as bigint) for j in range(40 + label)] as f from embeddings),
    m as (select max(len(f)) as w from s),
    p as (select *, row_number() over (order by md5('42:' || k || ':' || i), k, i) - 1 as r, count(*) over () as n from s),
    t as (select *, row_number() over (order by r) - 1 as pos from p where r >= greatest(1, cast(floor(n * 0.1::double) as bigint)))
    select cast(pos // 16 as bigint) as batch_id, cast(pos % 16 as bigint) as pos_in_batch, cast(label as bigint) as label,
      array_to_string(f || [0::bigint for j in range(w - len(f))], ' ') as features from t, m""",
)
def rebatch(spark, folder):
    vectors = table(spark, folder, "embeddings")
    width = F.lit(40) + F.col("label")
    feature = F.transform(F.slice("embedding", F.lit(1), width), lambda v: F.floor((v + 1) * 8))
    member = F.struct("vec_id", feature.alias("f"), "label")
    batches = vectors.groupBy(F.expr("vec_id div 7").alias("k")).agg(
        F.array_sort(F.collect_list(member)).alias("m")
    )
    given = batches.select("k", F.col("m.f").alias("features"), F.col("m.label").alias("labels"))
    out = split.rebatch(given, "k", 16, "train")
    return out.select(
        "batch_id",
        F.col("pos_in_batch").cast("bigint").alias("pos_in_batch"),
        F.col("label").cast("bigint").alias("label"),
        joined(F.col("features")).alias("features"),
    )
