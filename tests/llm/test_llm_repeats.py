"""Suffix order and passage removal against plain versions."""

import random

import numpy as np
import pytest

from millrace.llm import repeats, suffixes


@pytest.mark.parametrize("seed", range(60))
def test_two_stage_order_and_prefixes(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([b"ab", b"a", b"ab\0", bytes(range(256))])
    body = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 200)))
    raw = b"\0" + body + b"\0" * suffixes.PAD
    text = np.frombuffer(raw, np.uint8)
    wanted = np.zeros(len(raw), bool)
    wanted[[i for i in range(1, len(body) + 1) if rng.random() < 0.7]] = True
    depth = 50
    order = suffixes.two_stage_order(text, wanted, depth).tolist()
    assert sorted(order) == np.flatnonzero(wanted).tolist()
    heads = [raw[i : i + depth].ljust(depth, b"\0") for i in order]
    assert heads == sorted(heads)
    shared = suffixes.common_prefixes(text, np.array(order, np.int64), depth).tolist()
    for k in range(1, len(order)):
        a, b = heads[k - 1], heads[k]
        same = next((i for i in range(depth) if a[i] != b[i]), depth)
        assert shared[k] == same


def removed(rows, length):
    """Per row the bytes left and the spans removed, window by window."""
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for doc, text in data:
        for i in range(len(text) - length + 1):
            w = text[i : i + length]
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in data:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if doc is not None and first[text[i : i + length]] < doc:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans, at = [], None
        for i, g in enumerate([*gone, False]):
            if g and at is None:
                at = i
            if not g and at is not None:
                spans.append((at, i))
                at = None
        out.append((doc, len(text), spans, kept))
    return out


def rows_of(rng, n):
    words = ["alpha", "βeta", "gamma", "δ", "epsilon", "zeta", "eta", "x"]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.6 else " ".join(rng.choice(words) for _ in range(12)))
        rows.append((rng.randint(0, 10**6) * 1000 + i, "\n".join(parts)))
    rows += [(5, "ab" * 300), (6, "ab" * 200), (7, "x" * 49), (8, "x" * 50), (9, "x" * 120), (10, None), (11, "")]
    rows += [(12, rows[0][1]), (13, rows[0][1]), (None, rows[1][1]), (None, rows[1][1]), (14, "A\0B" * 40), (15, "A\0B" * 40)]
    rows += [(16, passages[0] + " " + passages[1]), (16, passages[0]), (17, " ".join(passages) * 20)]
    return rows


@pytest.mark.parametrize("hot", [repeats.HOT_DOCS, 3])
def test_removal_matches_the_plain_version(spark, hot, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_BYTES", 8000)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 4000)
    rows = rows_of(random.Random(4), 60)
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id bigint, text string, part string, bucket int")
    got = [
        (r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
        for r in repeats.remove_repeats(docs, hot_docs=hot).collect()
    ]
    assert sorted(got, key=repr) == sorted(removed(rows, 50), key=repr)


def test_other_lengths(spark):
    rows = rows_of(random.Random(9), 20)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [
        (r["doc_id"], r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
        for r in repeats.remove_repeats(docs, length=33, gram=11).collect()
    ]
    assert sorted(got, key=repr) == sorted(removed(rows, 33), key=repr)


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_equal_windows_have_equal_anchors(seed):
    rng = random.Random(seed)
    shared = bytes(rng.randrange(97, 123) for _ in range(90))
    a = bytes(rng.randrange(97, 123) for _ in range(70)) + shared + b"q" * 60
    b = shared + bytes(rng.randrange(97, 123) for _ in range(80))
    s = repeats.Stretches([a, b"short", b], 50, 20)
    by_window = {}
    for doc, start, stop, anchor in zip(s.doc, s.start, s.stop, s.anchor, strict=True):
        for w in range(start, stop):
            by_window.setdefault(s.data[w : w + 50].tobytes(), set()).add(int(anchor))
    assert all(len(v) == 1 for v in by_window.values())
    assert sum(s.stop - s.start) == len(a) + len(b) - 98
