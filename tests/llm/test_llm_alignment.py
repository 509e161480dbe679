"""Alignment against both tokenizers over whole texts, with byte ends from their decoded bytes alone."""

import hashlib
from collections import defaultdict
from itertools import accumulate

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", "\n", " \n\t ", "a", " a", "a  b", "a\n  b c", "a \n b\n\n\n  c", "x  y  z", "​ a",
    "it's we'll 'tis don't", "日本語 テキスト", "🙂 🙃🙂", "\U00012345x ﬁ ½ ａ", "é é ́", "a▁b", "▁",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "a <|endoftext|>b", "x" * 3000, "ab" * 500 + " " + "é" * 700, "   lead",
    "trail   ", "\r\n \x0b\x0c \x1c \x85 \x00", "don't!! x--y 12,345.67", "İ ΣΣ ẞ", "tab\tbed \t x",
]


def plain(text, a, b):
    """Ids and links of one text, from the definition."""
    if not text:
        return [], [], [], []
    whole = (" " + text).encode()
    left, right = a._a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [a._a_bytes[i] for i in left]
    b_bytes = [a._b_bytes[i] for i in right]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], [], []
    a_end, b_end = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
    links, first = [], 0
    for i, end in enumerate(a_end):
        start = end - len(a_bytes[i])
        while b_end[first] <= start:
            first += 1
        j = first
        while j < len(b_end) and b_end[j] - len(b_bytes[j]) < end:
            links.append((left[i], right[j]))
            j += 1
    a_at, b_at = {e: k for k, e in enumerate(a_end, 1)}, {e: k for k, e in enumerate(b_end, 1)}
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_end) & set(b_end)):
        m, n = a_at[cut], b_at[cut]
        groups.append(",".join(map(str, left[i:m])) + "|" + ",".join(map(str, right[j:n])))
        i, j = m, n
    return left, right, groups, links


def expected(rows):
    source = alignment.Aligner(*PATHS)
    found = [(doc, plain(text, source, source._b)) for doc, text in rows]
    counts = defaultdict(int)
    for _, (_, _, _, links) in found:
        for pair in set(links):
            counts[pair] += 1
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (
            doc, len(a), len(b), len(groups), len(links),
            sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc, (a, b, groups, links) in found
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(found):
    return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def test_whole_texts_against_both_tokenizers(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(3)
    assert rows_of(alignment.align_documents(docs, *PATHS)) == sorted(expected(documents), key=repr)


def test_odd_texts_and_rows(spark):
    rows = [(i, text) for i, text in enumerate(ODD)] + [(None, "a b"), (None, None), (3, "a b"), (3, "a b"), (4, None)]
    docs = spark.createDataFrame(
        [(i, t, 1, [1], "x") for i, t in rows], "doc_id bigint, text string, place int, pairs array<int>, groups string"
    )
    assert rows_of(alignment.align_documents(docs, *PATHS)) == sorted(expected(rows), key=repr)


def test_forgetting_chunks_changes_nothing(spark, documents, monkeypatch):
    texts = [t or "" for _, t in documents[:60]]
    source = alignment.Aligner(*PATHS)
    whole = list(alignment.Remembered(source).of(texts))
    full = alignment.Remembered(source)
    list(full.of(texts))
    monkeypatch.setattr(alignment, "REMEMBERED_BYTES", 100_000)
    small = alignment.Remembered(source)
    assert [list(small.of([t]))[0] for t in texts] == whole
    assert len(small._young) + len(small._old) < len(full._young) / 4


@pytest.mark.parametrize("together", [1, 2, 7, 1024])
def test_chunks_encoded_together_are_the_chunks_alone(documents, monkeypatch, together):
    monkeypatch.setattr(alignment, "TOGETHER", together)
    source = alignment.Aligner(*PATHS)
    pieces = {c for t in ODD + [t or "" for _, t in documents[:10]] for c in alignment.BETWEEN_WORDS.split(t)} - {""}
    for order in (sorted(pieces), sorted(pieces, reverse=True)):
        assert list(source.chunks(order)) == list(source._one_by_one(order))


def test_groups_are_kept_on_request(spark):
    docs = spark.createDataFrame([(1, "Héllo"), (2, "")], "doc_id bigint, text string")
    found = {r["doc_id"]: r["groups"] for r in alignment.align_documents(docs, *PATHS, with_groups=True).collect()}
    source = alignment.Aligner(*PATHS)
    assert found == {1: ";".join(plain("Héllo", source, source._b)[2]), 2: ""}


def test_spans_are_refined_by_decoded_bytes():
    # a character of four bytes in four tokens: one span for all, or three empty ones
    assert alignment.byte_ends([(0, 1), (1, 5), (1, 5), (1, 5), (5, 6)], [1, 2, 1, 1, 1]) == [1, 3, 4, 5, 6]
    assert alignment.byte_ends([(0, 1), (0, 1), (0, 1), (0, 1), (0, 5), (5, 6)], [1] * 6) == [1, 2, 3, 4, 5, 6]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    found = alignment.align_documents(docs, *PATHS)
    assert found.count() == 0 and set(COLUMNS) <= set(found.columns)
    assert found.filter(F.col("n_a") > 0).count() == 0
