"""User functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.operators import hooks
from millrace.operators.position import permuted_position
from millrace.operators.split import assign_batches
from millrace.queries.registry import query, table
from millrace.sources.registry import reader_for


def _pairs(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("x"), F.col("label").cast("bigint").alias("y")
    )


@query(
    "ud1_sample_transform",
    "select vec_id, round(list_sum([2 * e::double for e in embedding]), 4) as total, cast(9 - label as bigint) as y from embeddings",
)
def sample_transform(spark, folder):
    out = hooks.transform_samples(
        _pairs(spark, folder),
        lambda xs: xs.map(lambda x: x * np.float32(2)),
        lambda ys: 9 - ys,
    )
    total = F.aggregate("x", F.lit(0.0), lambda a, e: a + e.cast("double"))
    return out.select("vec_id", F.round(total, 4).alias("total"), "y")


@query(
    "ud2_batch_transform",
    """with o as (select vec_id, label, row_number() over (order by md5('42:' || vec_id), vec_id) - 1 as pos from embeddings),
    m as (select *, max(label) over (partition by pos // 24) as top from o)
    select vec_id, cast(pos // 24 as bigint) as batch_id, cast(top - label as bigint) as y from m""",
)
def batch_transform(spark, folder):
    rows = permuted_position(_pairs(spark, folder).drop("x"), ["vec_id"], 42)
    batches = assign_batches(rows, 24)

    def below_top(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {"vec_id": batch["vec_id"], "batch_id": batch["batch_id"], "y": batch["y"].max() - batch["y"]}
        )

    return hooks.map_batches(batches, below_top, "vec_id bigint, batch_id bigint, y bigint")


@query(
    "ud3_map_samples",
    """select vec_id, round(list_sum([v::double * (v::double) for v in embedding]), 6) as x, cast(label + 1 as bigint) as y
       from embeddings""",
)
def map_samples(spark, folder):
    def squared(chunk: pd.DataFrame) -> pd.DataFrame:
        x = [float((np.asarray(x, np.float64) ** 2).sum()) for x in chunk["x"]]
        return pd.DataFrame({"vec_id": chunk["vec_id"], "x": x, "y": chunk["y"] + 1})

    found = hooks.map_samples(_pairs(spark, folder), squared, "vec_id bigint, x double, y bigint")
    return found.withColumn("x", F.round("x", 6))


@query(
    "ud4_transform_x_only",
    """select vec_id, round(list_sum([v::double for v in embedding]), 6) as x, cast(label as bigint) as y from embeddings""",
)
def transform_x_only(spark, folder):
    def total(xs: pd.Series) -> pd.Series:
        return xs.map(lambda x: float(np.asarray(x, np.float64).sum()))

    return hooks.map_column(_pairs(spark, folder), "x", total, "double").withColumn("x", F.round("x", 6))


@query(
    "ud4_transform_pair",
    """select vec_id, round(label * list_sum([v::double for v in embedding]), 6) as x, cast(len(embedding) - label as bigint) as y
       from embeddings""",
)
def transform_pair(spark, folder):
    def weighed(xs: pd.Series, ys: pd.Series) -> tuple[pd.Series, pd.Series]:
        return xs.map(lambda x: float(np.asarray(x, np.float64).sum())) * ys, xs.map(len) - ys

    found = hooks.transform_pair(_pairs(spark, folder), weighed, "double", "bigint")
    return found.withColumn("x", F.round("x", 6))


@query("ud6_reader_by_format", "select o_orderkey as id, o_totalprice as price from orders")
def reader_by_format(spark, folder):
    layout = {"id": {"column": "o_orderkey"}, "price": {"column": "o_totalprice"}}
    return reader_for("tabular")(spark, f"{folder}/orders.parquet", layout, "train")


@query(
    "ud7_predict",
    """select vec_id, round(list_sum([embedding[i + 1]::double * (i + 1) for i in range(64)]), 3) as prediction from embeddings""",
)
def predict(spark, folder):
    def load():
        weights = np.arange(1, 65, dtype=np.float64)
        return lambda batch: batch.astype(np.float64) @ weights

    out = hooks.predict(_pairs(spark, folder), load, ["x"], batch_size=256, input_shapes=[[64]])
    return out.select("vec_id", F.round("prediction", 3).alias("prediction"))


@query(
    "ud8_user_scorers",
    """with s as (select lang, quality, toxic, length(text) as n_chars from documents join labels using (doc_id))
    select lang, 'agree' as scorer, count(*) as n, round(avg(case when quality <> toxic then 1 else 0 end), 6) as score from s group by lang
    union all select lang, 'length', count(*), round(avg(n_chars), 6) from s group by lang""",
)
def user_scorers(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").select(
        "lang", "quality", "toxic", F.length("text").alias("chars")
    )
    scorers = {"agree": lambda c: c["quality"] != c["toxic"], "length": lambda c: c["chars"]}
    out = hooks.score_with(rows, ["lang"], scorers, ["quality", "toxic", "chars"])
    return out.withColumn("score", F.round("score", 6))
