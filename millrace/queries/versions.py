"""Versions: pins, lineage, differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import integrity
from millrace.queries.registry import query, table

VERSIONS = """
v as (select source as dataset_id, doc_id + 1 as version_number,
             'v-' || doc_id as id from documents)
"""


@query(
    "lv1_pin_version",
    f"""with {VERSIONS}, r as (
      select distinct source as dataset_id, unnest([null, '3', '99999', 'id']) as kind from documents),
    q as (select dataset_id, case when kind = 'id' then (select min(id) from v where v.dataset_id = r.dataset_id) else kind end as version from r),
    n as (select dataset_id, cast(version_number as varchar) as version, id from v union all select dataset_id, id, id from v),
    l as (select dataset_id, arg_max(id, version_number) as latest from v group by dataset_id)
    select q.dataset_id, q.version, case when q.version is null then latest else n.id end as id,
      case when q.version is null then q.dataset_id else q.dataset_id || '@' || q.version end as cache_key
    from q join l using (dataset_id) left join n on n.dataset_id = q.dataset_id and n.version = q.version""",
)
def pin_version(spark, folder):
    versions = table(spark, folder, "documents").select(
        F.col("source").alias("dataset_id"), (F.col("doc_id") + 1).alias("version_number"),
        F.concat(F.lit("v-"), F.col("doc_id")).alias("id"),
    )
    firsts = versions.groupBy("dataset_id").agg(F.min("id").alias("own"))
    asked = F.array(F.lit(None).cast("string"), F.lit("3"), F.lit("99999"), F.col("own"))
    requests = firsts.select("dataset_id", F.explode(asked).alias("version"))
    return integrity.pin_version(versions, requests)


@query(
    "lv2_lineage",
    """with recursive p as (select o_orderkey as id, case when o_orderkey % 100 = 0 then null
          when o_orderstatus = 'F' then o_orderkey - o_orderkey % 100 else o_orderkey - 1 end as up from orders),
    r as (select id, id as root, 0 as depth from p where up is null
          union all select p.id, r.root, r.depth + 1 from p join r on p.up = r.id)
    select id, root, cast(depth as bigint) as depth from r""",
)
def lineage(spark, folder):
    key = F.col("o_orderkey")
    # chains inside blocks of a hundred; a third of the versions hang on their block's root
    parent = F.when(key % 100 != 0, F.when(F.col("o_orderstatus") == "F", key - key % 100).otherwise(key - 1))
    versions = table(spark, folder, "orders").select(key.alias("id"), parent.alias("parent_version_id"))
    return integrity.lineage(versions)


@query(
    "lv3_version_diff",
    """select count(*) filter (o_orderstatus = 'F') as rows_removed, count(*) filter (o_orderpriority = '5-LOW' and o_orderstatus <> 'F') as rows_changed,
      count(*) filter (o_orderpriority = '1-URGENT') as rows_added,
      count(*) filter (o_orderpriority <> '5-LOW' and o_orderstatus <> 'F') as rows_kept from orders""",
)
def version_diff(spark, folder):
    old = table(spark, folder, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    changed = old.filter("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", F.when(low, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    added = old.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return integrity.version_diff(old, changed.unionByName(added), "o_orderkey")
