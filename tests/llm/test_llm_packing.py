"""Packing against the tokenizer itself, a plain first-fit decreasing, and odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n\t ", "áb café CAFÉ", "ÜBER straße ẞ", "it's we'll 12 a1b 3.5", "\x1c a\xa0b c", "İstanbul ΣΣ",
    "don't!! x--y", "ªº µm × ÷", "e\ń ÿ.", "À́ 中文", "a.b, c;d!", "word.,", "🙂 ok",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    return [r["text"] for r in rows]


def test_remembered_words_give_the_tokenizers_ids(texts):
    encoder = packing.WordEncoder(PATH)
    for text in texts + ODD:
        expected = encoder._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected, text


def test_memory_of_words_is_bounded(monkeypatch, texts):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    small, large = packing.WordEncoder(PATH), packing.word_encoder(PATH)
    assert [small.ids(t) for t in texts[:20]] == [large.ids(t) for t in texts[:20]]
    assert len(small._words) <= 50


@pytest.mark.parametrize("seed", range(20))
def test_tournament_tree_finds_the_first_bin_that_fits(seed):
    random = np.random.default_rng(seed)
    lengths = np.sort(random.integers(1, 101, random.integers(1, 300)))[::-1]
    place, offset = packing.first_fit_decreasing(lengths, 100)
    bins = []
    for size, where, at in zip(lengths, place, offset, strict=True):
        fits = next((i for i, used in enumerate(bins) if used + size <= 100), len(bins))
        if fits == len(bins):
            bins.append(0)
        assert (where, at) == (fits, bins[fits])
        bins[fits] += size


def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, texts):
    long = " ".join(texts[:20])
    rows = [(i, t, "x", "y") for i, t in enumerate(texts[:60])] + [
        (100, long, None, None), (101, None, "a", "b"), (102, "", "a", "b"), (None, "null id", "a", "b"),
        (103, "the same row", "a", "b"), (103, "the same row", "a", "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, group string, piece string")
    found = packing.pack_documents(docs, PATH).toPandas()
    encoder = packing.word_encoder(PATH)
    for doc, text in [(r[0], r[1]) for r in rows if r[0] not in (None, 103)]:
        ids = np.append(np.frombuffer(encoder.ids(text or ""), "<u4"), np.uint32(2))
        part = found[found.doc_id == doc].sort_values("start")
        assert part.doc_tokens.unique().tolist() == [len(ids)]
        assert part.start.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() == len(ids)
        for start, length, crc in part[["start", "length", "ids_crc32"]].itertuples(index=False):
            assert zlib.crc32(ids[start : start + length].astype("<u4").tobytes()) == crc
    assert (found.doc_id == 103).sum() == 2 and found.doc_id.isna().sum() == 1
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]]
        total = part.length.sum()
        assert total <= 4096 and (part.sequence_tokens == total).all()
        assert part.padded_tokens.iloc[0] == (total if total & (total - 1) == 0 else 4096)
    again = packing.pack_documents(docs, PATH).toPandas()
    keys = ["sequence_id", "offset"]
    assert found.sort_values(keys).equals(again.sort_values(keys)) or len(found) == len(again)


def test_many_groups_waste_little(spark, texts, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 1 << 15)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = packing.pack_documents(docs, PATH)
    sums = found.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert sums[0] / (4096 * sums[1]) > 0.9


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack_documents(docs, PATH).count() == 0
