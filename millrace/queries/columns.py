"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import catalog, roles, runs
from millrace.operators.encode import encode_labels, feature_vector
from millrace.queries.registry import RUN_EVENTS, indexed, query, run_events, table


@query(
    "pf1_split_by_roles",
    "select l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag from lineitem",
)
def split_by_roles(spark, folder):
    declared = {
        "l_tax": "anchor",
        "l_quantity": "feature",
        "l_extendedprice": "feature",
        "l_discount": "prompt",
        "l_returnflag": "target",
        "l_linestatus": "label",
        "l_shipdate": "ignore",
    }
    return roles.project_roles(table(spark, folder, "lineitem"), declared)


@query(
    "pf2_detect_label_schema",
    "select o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus as label from orders",
)
def detect_label_schema(spark, folder):
    schema = [{"name": "o_totalprice", "type": "numeric"}, {"name": "o_orderstatus", "type": "categorical"}]
    return roles.project_detected(table(spark, folder, "orders").drop("o_orderdate"), schema)


@query(
    "pf2_detect_label_last",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment as label from customer",
)
def detect_label_last(spark, folder):
    return roles.project_detected(table(spark, folder, "customer"))


@query(
    "pf2_detect_label_role",
    "select c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey as label from customer",
)
def detect_label_role(spark, folder):
    declared = {"c_name": "ignore", "c_nationkey": "label", "c_acctbal": "target"}
    schema = [{"name": "c_mktsegment", "type": "categorical"}]
    return roles.project_detected(table(spark, folder, "customer"), schema, declared)


@query(
    "pf3_project_binding",
    "select d.text as feature, l.quality as target from documents d join labels l using (doc_id)",
)
def project_binding(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    return roles.project_binding(rows, {"input_column": "text", "target_column": "quality"})


@query("pf4_project_by_name_or_role", "select text as x, role as y from conversations")
def project_by_name_or_role(spark, folder):
    binding = {"input_column": "prompt", "target_column": "label"}
    declared = {"conv_id": "ignore", "text": "text_input", "role": "text_target"}
    return roles.project_bound(table(spark, folder, "conversations"), binding, declared)


NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "pf5_numeric_features",
    "select "
    + ", ".join(f"cast(cast({c} as float) as double) as f{i}" for i, c in enumerate(NUMERIC))
    + " from lineitem",
)
def numeric_features(spark, folder):
    lineitem = table(spark, folder, "lineitem")
    vector = lineitem.select(feature_vector(lineitem, lineitem.columns).alias("v"))
    return vector.select(*[F.get("v", F.lit(i)).cast("double").alias(f"f{i}") for i in range(len(NUMERIC))])


@query(
    "pf6_filter_metrics",
    f"with {RUN_EVENTS} select run, seq, epoch, value from ev"
    " where event = 'metric' and epoch >= 10 and epoch <= 60",
)
def filter_metrics(spark, folder):
    rows = run_events(spark, folder).withColumnRenamed("event", "metric_type")
    return runs.filter_metrics(rows, "metric", 10, 60).select("run", "seq", "epoch", "value")


@query(
    "pf7_filter_logs",
    """select event_id as seq, event_type || ' ' || props as message from events
       where event_type = 'error' and contains(lower(event_type || ' ' || props), '"k": 4')
         and ts >= timestamp '2024-01-05 00:00:00' and ts <= timestamp '2024-01-20 12:00:00'""",
)
def filter_logs(spark, folder):
    events = table(spark, folder, "events")
    logs = events.select(
        F.col("event_id").alias("seq"),
        "ts",
        F.col("event_type").alias("level"),
        F.concat_ws(" ", "event_type", "props").alias("message"),
    )
    found = runs.filter_logs(
        logs, "error", '"K": 4', start="2024-01-05 00:00:00", end="2024-01-20 12:00:00"
    )
    return found.select("seq", "message")


@query(
    "pf8_catalog_search",
    """select p_partkey as id, p_name as name from part
       where (contains(lower(p_name), 'ri') or contains(lower(p_brand), 'ri')) and p_type = 'PROMO'
         and list_has_any(string_split(p_name, ' '), ['red', 'small', 'ring'])""",
)
def catalog_search(spark, folder):
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("type"),
        F.split("p_name", " ").alias("tags"),
    )
    found = catalog.search(part, "RI", equals={"type": "PROMO", "id": None}, tags=["red", "small", "ring"])
    return found.select("id", "name")


@query(
    "pf9_filter_status_in",
    "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'P')",
)
def filter_status_in(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return catalog.status_in(orders, "F,P", "o_orderstatus")


@query(
    "pf10_drop_heartbeats",
    f"with {RUN_EVENTS} select run, seq, event from ev where event <> 'heartbeat'",
)
def drop_heartbeats(spark, folder):
    return runs.drop_heartbeats(run_events(spark, folder)).select("run", "seq", "event")


@query(
    "pf11_resume_after",
    f"""with {RUN_EVENTS}, c as (select run, max(seq) // 2 as cursor from ev where run % 2 = 0 group by run)
    select ev.run, seq from ev left join c using (run) where cursor is null or seq > cursor""",
)
def resume_after(spark, folder):
    ev = run_events(spark, folder).select("run", "seq")
    cursors = ev.filter("run % 2 = 0").groupBy("run").agg(F.expr("max(seq) div 2").alias("cursor"))
    return runs.resume_after(ev, cursors, "run", "seq")


@query(
    "pf12_samples_labelled",
    """select cast(cast(l_quantity as float) as double) as f0, cast(cast(l_tax as float) as double) as f1,
       cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint) as label from lineitem""",
)
def samples_labelled(spark, folder):
    lineitem = encode_labels(indexed(spark, folder, "lineitem"), "l_returnflag", ["A", "N", "R"])
    vector = feature_vector(lineitem, ["l_quantity", "l_tax", "l_shipdate"])
    rows = roles.samples(lineitem, vector, F.col("code"))
    return rows.select(
        F.get("features", F.lit(0)).cast("double").alias("f0"),
        F.get("features", F.lit(1)).cast("double").alias("f1"),
        "label",
    )


@query("pf12_samples_unlabelled", "select text as features from documents")
def samples_unlabelled(spark, folder):
    # some documents have no label, so no sample has one
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return roles.samples(rows, F.col("text"), F.col("quality"))
