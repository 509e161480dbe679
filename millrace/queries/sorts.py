"""Orders, pages, top lists and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import tokens
from millrace.operators import catalog, runs
from millrace.operators.split import permuted_holdout, ratio_split
from millrace.queries.registry import query, sql_tokens, table
from millrace.sources.folders import class_folder_files, sort_files


@query(
    "st1_most_common",
    f"""select token, count(*) as n from (select unnest({sql_tokens('text')}) as token from documents)
    group by token order by n desc, token limit 100""",
)
def most_common(spark, folder):
    docs = table(spark, folder, "documents")
    return catalog.most_common(docs.select(F.explode(tokens(F.col("text"))).alias("token")), "token", 100)


@query(
    "st2_paginate",
    """select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50 offset 100""",
)
def paginate(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return catalog.paginate(orders, 3, 50, "o_totalprice", "o_orderkey")


@query(
    "st2_page_after",
    """with last as (select o_totalprice as v, o_orderkey as k from orders where o_orderkey = 77)
    select o_orderkey, o_totalprice from orders, last
    where o_totalprice < v or (o_totalprice = v and o_orderkey > k)
    order by o_totalprice desc, o_orderkey limit 50""",
)
def page_after(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    row = orders.filter("o_orderkey = 77").first()
    return catalog.page_after(orders, (row["o_totalprice"], row["o_orderkey"]), 50, "o_totalprice", "o_orderkey")


@query(
    "st2_page_info",
    """select cast(3 as bigint) as page, greatest(1, cast(ceil(count(*) / 50.0) as bigint)) as pages, count(*) as total from orders""",
)
def page_info(spark, folder):
    info = catalog.page_info(table(spark, folder, "orders"), 3, 50)
    return info.select(F.col("page").cast("bigint").alias("page"), "pages", "total")


@query(
    "st3_newest_first",
    """select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders
       order by o_orderdate desc, o_orderkey desc limit 50""",
)
def newest_first(spark, folder):
    rows = catalog.newest_first(table(spark, folder, "orders"), "o_orderdate", "o_orderkey")
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query(
    "st4_trending",
    """select user_id, count(*) as n from events where ts > timestamp '2024-01-20 00:00:00' - interval 7 day
       and ts <= timestamp '2024-01-20 00:00:00' group by user_id order by n desc, user_id limit 20""",
)
def trending(spark, folder):
    return runs.trending(table(spark, folder, "events"), "user_id", "ts", "2024-01-20 00:00:00", 7, 20)


@query(
    "st5_file_order",
    """with f as (select lang, 'Doc-' || doc_id || case when doc_id % 5 = 0 then '.PNG' when doc_id % 5 = 1 then '.txt' else '.jpg' end as name from documents),
    c as (select lang, row_number() over (order by lang) - 1 as label from (select distinct lang from f))
    select lang as class_name, cast(label as bigint) as label, name as file_name,
      cast(row_number() over (order by lang, name) - 1 as bigint) as place from f join c using (lang) where not name like '%.txt'""",
)
def file_order(spark, folder):
    from millrace.operators.position import ordered_position

    docs = table(spark, folder, "documents")
    part = F.col("doc_id") % 5
    ending = F.when(part == 0, ".PNG").when(part == 1, ".txt").otherwise(".jpg")
    name = F.concat(F.lit("Doc-"), F.col("doc_id"), ending)
    files = docs.select(F.concat_ws("/", "lang", name).alias("relative"))
    media = class_folder_files(files).select("class_name", "label", "file_name")
    return ordered_position(sort_files(media), ["class_name", "file_name"], "place")


@query(
    "se1_union_rows",
    """select cast(s_suppkey as varchar) as id, s_name as name, printf('%.2f', s_acctbal) as balance, '-' as segment from supplier
       union all select cast(c_custkey as varchar), c_name, '-', c_mktsegment from customer""",
)
def union_rows(spark, folder):
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.format_string("%.2f", "s_acctbal").alias("balance"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return catalog.union_rows(suppliers, customers)


@query(
    "se2_classes_over_splits",
    """select lang as class_name, cast(row_number() over (order by lang) - 1 as bigint) as class_index from (
         select lang from documents where source < 'src2' union select lang from documents where source >= 'src2')""",
)
def classes_over_splits(spark, folder):
    docs = table(spark, folder, "documents").select("lang", "source")
    both = docs.filter("source < 'src2'").union(docs.filter("source >= 'src2'"))
    return catalog.distinct_classes(both, "lang")


@query(
    "se3_complement",
    """with o as (select vec_id, row_number() over (order by md5('42:' || vec_id), vec_id) - 1 as p, count(*) over () as n from embeddings)
    select vec_id from o where p >= cast(floor(n * 0.1::double) as bigint)""",
)
def complement(spark, folder):
    rows = table(spark, folder, "embeddings").select("vec_id")
    # a predicate on the row's own place: no set difference needed
    return permuted_holdout(rows, ["vec_id"], 0.1).filter("split = 'train'").select("vec_id")


@query(
    "se4_overlap",
    """with a as (select doc_id, row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as p, count(*) over () as n from documents),
    b as (select doc_id, row_number() over (order by md5('43:' || doc_id), doc_id) - 1 as p, count(*) over () as n from documents)
    select doc_id from a where p >= n - cast(floor(n * 0.1::double) as bigint)
    intersect select doc_id from b where p < n - 2 * cast(floor(n * 0.1::double) as bigint)""",
)
def overlap(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    tested = ratio_split(docs, ["doc_id"], seed=42).filter("split = 'test'").select("doc_id")
    trained = ratio_split(docs, ["doc_id"], seed=43).filter("split = 'train'").select("doc_id")
    return tested.intersect(trained)
