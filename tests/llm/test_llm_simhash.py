"""Fingerprints and components against plain versions, crowded buckets, odd rows."""

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_print(text):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_parts(prints, radius=2):
    """The smallest member of each print's component."""
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            parent[p] = parent[parent[p]]
            p = parent[p]
        return p

    for a, b in combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {p: root(p) for p in parent}


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    parts = plain_parts(prints)
    least = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[parts[p]] = min(doc, least.get(parts[p], doc))
    return sorted(
        ((doc, f"{p:016x}", least.get(parts[p])) for (doc, _), p in zip(rows, prints, strict=True)), key=repr
    )


def found(docs):
    rows = simhash.link_documents(docs).select(
        "doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id"
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def test_whole_texts(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    assert found(docs) == expected(documents)


def test_hash_is_sparks_own(spark):
    text = "drei kurze wörter"
    row = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("radius", [2, 4])
def test_every_pair_within_the_radius_shares_a_table(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    pick = random.Random(3)
    bits = list(combinations(range(64), 2)) if radius == 2 else [pick.sample(range(64), 4) for _ in range(2000)]
    for places in bits:
        differ = sum(1 << b for b in places)
        assert any(mask & differ == 0 for mask in masks)


@pytest.mark.parametrize("small", [1, 4, 32])
def test_crowded_buckets_lose_no_link(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    pick = random.Random(small)
    prints = set()
    for _ in range(6):
        centre = pick.getrandbits(64)
        for _ in range(60):
            near = centre
            for bit in pick.sample(range(64), pick.randint(0, 4)):
                near ^= 1 << bit
            prints.add(near)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.print_links(spark.createDataFrame([(p,) for p in signed], "print bigint")).collect()
    pairs = [(a % (1 << 64), b % (1 << 64)) for a, b in links]
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in pairs)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    assert {p: root(p) for p in prints} == plain_parts(prints)


def test_odd_rows(spark):
    rows = [
        (5, None), (4, ""), (None, " \n\t"), (7, "One two"), (6, "one TWO"), (None, "one\ttwo"), (1, "É é"), (2, "é é"),
        (3, "a b c d"), (3, "a b c d"), (3, "other words stand here"), (None, "alone and without id"), (9, "x" * 5000),
        (8, "word " * 50_000), (10, "word  word\x0bword"), (11, "\x1cword b c"),
    ]
    docs = spark.createDataFrame([(i, t, 0, "p") for i, t in rows], "doc_id bigint, text string, print int, label string")
    assert found(docs) == expected(rows)


def test_a_tie_leaves_the_bit_unset():
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d")]
    assert simhash.fingerprint(b"A b c d") == hashes[0] & hashes[1]


def test_empty_table(spark):
    assert simhash.link_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
