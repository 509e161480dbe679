"""One query per operator, over whole tables and with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment,
    language_model,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    repeats,
    secrets,
    simhash,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "path",
        "threshold",
    )


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_words(table(spark, folder, "documents"))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def _secrets_sql() -> str:
    """The same spans without an index: every rule searched in every text."""
    each = []
    for number, rule in enumerate(secrets.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        each.append(f"""
          list_filter(list_transform(range(1, len(regexp_extract_all(t, {pattern}, 0)) + 1), lambda k: {{
            'start': list_sum(list_transform(regexp_split_to_array(t, {pattern})[1:k], lambda x: length(x)))
              + coalesce(list_sum(list_transform(
                  regexp_extract_all(t, {pattern}, 0)[1:k - 1], lambda x: length(x))), 0),
            'kind': {number},
            'length': length(regexp_extract_all(t, {pattern}, 0)[k]),
            'counted': length(regexp_extract_all(t, {pattern}, {rule.group})[k])}}),
            lambda s: s.counted >= {rule.least})""")
    kinds = "[" + ", ".join(f"'{rule.kind}'" for rule in secrets.RULES) + "]"
    base = len(secrets.BASE)
    joined = (
        "list_transform({}, lambda s: {}[s.kind + 1] || ':' || cast(s.start as bigint) || ':' || "
        "cast(s.start + s.length as bigint))"
    )
    counts = ", ".join(
        f"cast(len(list_filter(spans, lambda s: s.kind = {n})) as bigint) as n_{rule.kind}"
        for n, rule in enumerate(secrets.BASE)
    )
    first = joined.format(f"list_filter(spans, lambda s: s.kind < {base})", kinds)
    return f"""
    with d as (select doc_id, coalesce(text, '') as t from documents),
    s as (select doc_id, list_sort(flatten([{", ".join(each)}])) as spans from d)
    select doc_id, {counts}, sha256(coalesce(array_to_string({first}, ','), '')) as base_sha256,
           coalesce(array_to_string({joined.format("spans", kinds)}, ','), '') as spans from s"""


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(
        table(spark, folder, "documents"), table(spark, folder, "labels")
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "toxicity", "toxic")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align_documents(
        table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)
    )
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    linked = simhash.link_documents(table(spark, folder, "documents"))
    return linked.select(
        "doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id"
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_model": op4_language_model,
    "op5_neighbours": op5_neighbours,
    "op6_repeats": op6_repeats,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_secrets": op8_secrets,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_toxicity": op10_toxicity,
    "op11_alignment": op11_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}
ORACLES: dict[str, str] = {"op8_secrets": _secrets_sql()}
