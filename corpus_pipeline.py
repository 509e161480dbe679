"""A corpus from raw documents to packed sequences, stage by stage.

Each stage gets what the one before it kept. All but the last return the columns of ``documents``:
toxic rows go, of near duplicates one row stays, secrets are blotted out, rows are dropped or repeated
to bring the sources to their weights. The last returns pieces of documents and where they lie.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, near_duplicates, packing, secrets, toxicity
from millrace.llm.queries import TOKENIZER, table
from millrace.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not toxic; the chain learns from the labels of those it is given."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id."""
    return near_duplicates.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret and ``n_chars`` adjusted."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, from not at all to three times."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences; a document that the mix repeats is packed each time."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Classifiers, signatures and packing are not expressible in SQL; tests compare the stages with plain
# versions of what they do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
