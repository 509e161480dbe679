"""SimHash fingerprints and links between them by covering locality-sensitive hashing.

The fingerprint of a text has a bit set where most hashes of its shingles have it set. To find all
pairs that differ in at most ``r`` bits, every bit position is given a non-zero vector of ``r + 1``
bits. For each non-zero vector ``v`` one table keeps the bits whose vector has an odd number of ones in
common with ``v``. The vectors of ``r`` differing bits span at most ``r`` dimensions, so some ``v`` is
orthogonal to all of them: its table keeps none of the differing bits, and the pair meets there for sure.
With ``r = 2`` there are 7 tables of about 37 of the 64 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.base import documents_of
from millrace.llm.near_duplicates import components
from millrace.operators.joins import lookup_join
from millrace.session import materialize

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
# Shingles hashed together; their bits take 64 bytes each.
BLOCK = 1 << 14
# In buckets up to this size every two fingerprints are compared; those of larger ones meet by the
# fingerprints one bit away from them. Both find every link.
SMALL_BUCKET = 32

_BLANKS = re.compile(rb"[\x09-\x0d ]+")


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = _BLANKS.sub(b" ", text.lower()).strip(b" ")
    if not words:
        return 0
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.append(blanks, len(words))
    if len(starts) > shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        block = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(words[i:j], seed) for i, j in block], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                fingerprint(value.as_py().encode("utf-8", "surrogatepass"), shingle, seed) for value in batch.column(1)
            ]
            prints = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Per row ``doc_id`` and ``print``, the fingerprint as a signed 64-bit number.

    The letters A to Z count as lower case. Shingles are runs of ``shingle`` words, as often as they
    occur; fewer words are one shingle, and a text without words (or null) has fingerprint 0.
    """
    rows = documents_of(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_fingerprints(shingle, seed), "doc_id bigint, print bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask of bit positions per table, as signed numbers; see the top of the module."""
    vectors = 1 << (radius + 1)
    masks = []
    for v in range(1, vectors):
        mask = sum(1 << bit for bit in range(bits) if ((bit % (vectors - 1) + 1) & v).bit_count() % 2)
        masks.append(mask - (1 << bits) if mask >> (bits - 1) else mask)
    return masks


def _near(a: Column, b: Column, radius: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def _within(radius: int) -> Column:
    """The links ``(a, b)`` between members of a bucket, its array ``members``."""

    def later(a: Column, place: Column) -> Column:
        rest = F.slice("members", place + 2, F.size("members"))
        return F.transform(F.filter(rest, lambda b: _near(a, b, radius)), lambda b: F.struct(a.alias("a"), b.alias("b")))

    return F.explode(F.flatten(F.transform("members", later)))


def _flips(half: int) -> Column:
    """The fingerprints at most ``half`` bits away from ``print``."""
    ways = F.array(F.col("print"))
    single = F.array(*[F.lit(1 << b if b < BITS - 1 else -(1 << b)) for b in range(BITS)])
    for _ in range(half):
        ways = F.array_distinct(
            F.concat(ways, F.flatten(F.transform(ways, lambda w: F.transform(single, lambda m: w.bitwiseXOR(m)))))
        )
    return ways


def print_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``print`` values at most ``radius`` bits apart.

    Every such pair shares a bucket of one of the tables. In a small bucket all links are found by
    comparing its members. In a large one (many texts that differ in a few words) that would grow with
    the square of the bucket: there each member names all fingerprints half the radius away. Two
    members that name the same one are at most ``radius`` apart, and any two that are so near name one
    in common; a name has at most as many members as there are fingerprints around it (65 with a radius
    of 2), so it needs no comparison: its members are linked to the first. Needs an even radius.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("print").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(covering_masks(radius))
    ])
    keyed = prints.select("print", F.explode(masks).alias("at")).select("print", "at.part", "at.key")
    sizes = (
        keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").withColumn("n", F.col("size"))
    )
    members = materialize(lookup_join(keyed, sizes, ["part", "key"], weight="n", how="inner"), "members")
    small = members.filter(F.col("size") <= SMALL_BUCKET).groupBy("part", "key").agg(
        F.collect_list("print").alias("members")
    )
    found = small.select(_within(radius).alias("link")).select("link.a", "link.b")
    crowded = members.filter(F.col("size") > SMALL_BUCKET).select("print").distinct()
    named = crowded.select("print", F.explode(_flips(radius // 2)).alias("name"))
    around = named.groupBy("name").agg(F.collect_list("print").alias("members")).filter(F.size("members") > 1)
    first = F.array_min("members")
    star = around.select(first.alias("a"), F.explode("members").alias("b")).filter(F.col("a") != F.col("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(star).distinct()


def link_documents(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Per row ``doc_id``, ``print``, and ``component_id``, the smallest id that can be reached.

    Two rows are linked if their fingerprints differ in at most ``radius`` bits; equal fingerprints
    (copies, all texts without words) are one node, so however many rows share one, they are one row
    in all joins but the last, which spreads the rows of common fingerprints. A node has at most 2,080
    neighbours. Rows with a null id take part and get the component's smallest id, null if it has
    none. Rows that share an id are linked by their texts only. An empty table gives an empty result.
    """
    stored = materialize(fingerprints(docs, shingle, seed), "prints")
    nodes = materialize(
        stored.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes"
    )
    labels = components(print_links(nodes.select("print"), radius))
    part = F.coalesce("label", "print")
    placed = nodes.join(labels.withColumnRenamed("doc", "print"), "print", "left").select(
        "print", "n", "least", part.alias("part")
    )
    parts = placed.groupBy("part").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("weight"))
    named = lookup_join(placed.select("print", "n", "part"), parts, ["part"], weight="weight", how="inner")
    return lookup_join(stored, named.drop("part"), ["print"], weight="n", how="inner")


def hexadecimal(fingerprint: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
