"""Dataset metadata records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The required fields of a metadata record.
TEXT_FIELDS = ("id", "name", "format", "dataset_type")
COUNT_FIELDS = ("num_samples", "num_classes")


def _kind(path: str) -> Column:
    return F.expr(f"schema_of_variant(variant_get(_v, '{path}', 'variant'))")


def read_metadata(records: DataFrame, column: str = "meta") -> DataFrame:
    """Typed metadata rows from JSON text, with ``problem`` naming the first bad field.

    Text and count fields must be there with their type (true is no count). Absent optional fields
    are null; ``class_names`` must be a list of texts and ``feature_schema`` an object.
    """
    parsed = records.withColumn("_v", F.try_parse_json(column))
    problem = F.when(F.col("_v").isNull(), "not JSON")
    typed: list[Column] = []
    for field in TEXT_FIELDS:
        good = F.coalesce(_kind(f"$.{field}") == "STRING", F.lit(False))
        problem = problem.when(~good, field)
        value = F.expr(f"try_variant_get(_v, '$.{field}', 'string')")
        typed.append(F.when(good, value).alias(field))
    for field in COUNT_FIELDS:
        good = F.coalesce(_kind(f"$.{field}") == "BIGINT", F.lit(False))
        problem = problem.when(~good, field)
        value = F.expr(f"try_variant_get(_v, '$.{field}', 'bigint')")
        typed.append(F.when(good, value).alias(field))
    names = F.coalesce(_kind("$.class_names"), F.lit("VOID"))
    listed = names.isin("VOID", "ARRAY<STRING>", "ARRAY<VOID>") & ~(
        (names == "ARRAY<VOID>") & (F.expr("size(try_variant_get(_v, '$.class_names', 'array<string>'))") > 0)
    )
    problem = problem.when(~listed, "class_names")
    shape = F.coalesce(_kind("$.feature_schema"), F.lit("VOID"))
    problem = problem.when((shape != "VOID") & ~shape.startswith("OBJECT"), "feature_schema")
    columns = F.expr(
        "try_variant_get(_v, '$.feature_schema.columns', 'array<struct<name:string,type:string>>')"
    )
    return parsed.select(
        *[c for c in records.columns if c != column],
        *typed,
        F.expr("try_variant_get(_v, '$.class_names', 'array<string>')").alias("class_names"),
        columns.alias("feature_columns"),
        problem.alias("problem"),
    )
