"""What the text operators share: inputs reduced to the columns they use, words, bounded samples."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the contracts: a word is a run of characters that are not one of these six.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


def documents_of(docs: DataFrame, *columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and the named columns; every other column is left out.

    Operators start from this, so extra columns of the input can't clash with names they use.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in columns],
    )


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def groups_for(total: int | None, per_group: int, least: int = 1) -> int:
    """How many groups hold ``total`` at about ``per_group`` each."""
    return max(least, math.ceil((total or 0) / per_group))


def remainder(column: str = "doc_id", parts: int = 5) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, rows: int, seed: int, strata: int = 2
) -> DataFrame:
    """At most ``rows`` labelled documents ``(doc_id, label, text)``, the same number per label.

    Per label the rows with the smallest seeded hash are taken: a bounded sample that does not
    depend on how the table is split. Labels that are null, and ids that are null, take no part; of
    several labels of one id the largest counts, of several rows of one id the one with the smallest
    text. Only the chosen ids are broadcast, at most ``rows`` of them.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(target)).cast("int").alias("label"))
        .withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id")))
    )
    share = rows // strata
    chosen = None
    for label in range(strata):
        part = known.filter(F.col("label") == label).orderBy("h", "doc_id").limit(share)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.join(F.broadcast(chosen.drop("h")), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def same(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of two lists of columns."""
    result = F.lit(True)
    for a, b in zip(left, right, strict=True):
        result = result & a.eqNullSafe(b)
    return result
