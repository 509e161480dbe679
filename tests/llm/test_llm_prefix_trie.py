"""The trie against a plain one, many shards, long and odd conversations; parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import prefix_trie
from millrace.llm.parentheses import Parentheses

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """The nodes from the definition; ``rows`` have no ties but equal rows."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))  # the remainder has the sign of the number
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, d == len(path)))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[b] for b in below) or 1
        own_bytes = len(path[-1][1].encode()) if path else 0
        saved[path] = (len(members[path]) - 1) * own_bytes + sum(saved[b] for b in below)
    found = []
    for path, inside in members.items():
        ends = ",".join(str(c) for c, last in inside if last)
        parent = members[path[:-1]][0][0] if path else None
        found.append(
            (
                inside[0][0], len(path), parent, len(inside), len(children[path]), leaves[path], saved[path],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(found, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", depth int, m int, path string")
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(table).select(*COLUMNS).collect()), key=repr)


def made(seed, convs=300, turns=12, words=3):
    """Conversations of few different turns, so that many share their beginnings."""
    pick = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(pick.randint(0, turns) if pick.random() < 0.9 else 0):
            rows.append((c, t, "ua"[t % 2], "w" * pick.randint(0, words) + "é" * (pick.random() < 0.1)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_beginnings(spark, seed):
    rows = made(seed)
    assert found(spark, rows) == plain(rows)


def test_given_conversations(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("shard", [1, 40])
def test_spines_of_many_shards_merge(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = made(5, convs=400, turns=10, words=2)
    assert found(spark, rows) == plain(rows)


def test_copies_of_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    long = [(t, "u", f"turn {t % 7}") for t in range(200)]
    rows = [(c, *t) for c in (5, 10, 15, 16, 20, 21) for t in long]
    rows += [(25, *t) for t in long[:90]] + [(30, *t) for t in long[:90]] + [(30, 90, "a", "other")]
    assert found(spark, rows) == plain(rows)


def test_one_beginning_of_all(spark):
    rows = [(c, 0, "system", "be kind") for c in range(0, 500, 5)] + [(c, 1, "user", str(c % 3)) for c in range(0, 500, 5)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "u", "a"), (1, 0, "u", "a"), (1, None, None, "first"), (2, 5, "u", None), (2, 7, None, None),
        (None, 0, "u", "no id"), (3, 0, "", ""), (7, 0, "ab", "c"), (8, 0, "a", "bc"), (0, 0, "u", "x" * 100_000),
        (-3, 0, "u", "below"), (-5, 0, "u", "zero"), (4, 1, "u", "a"), (9, 3, "u", "a"), (1 << 40, 0, "u", "a"),
    ]
    assert found(spark, rows) == plain(rows)


def test_one_conversation_and_none(spark):
    rows = [(6, t, "u", "t") for t in range(12)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("nodes", [1, 2, 63, 64, 65, 1000, 20_000])
def test_parentheses_against_a_stack(nodes):
    pick = random.Random(nodes)
    bits, open_nodes, left = [1], 1, nodes - 1
    while left or open_nodes > 1:
        if left and (open_nodes == 1 or pick.random() < 0.5 + 0.4 * (nodes % 2)):
            bits.append(1)
            open_nodes, left = open_nodes + 1, left - 1
        else:
            bits.append(0)
            open_nodes -= 1
    bits.append(0)
    expected, stack = {}, []
    for i, bit in enumerate(bits):
        if bit:
            stack.append(i)
        else:
            expected[stack.pop()] = i
    tree = Parentheses(np.array(bits, np.int8))
    close = tree.find_close()
    assert dict(zip(tree.opened.tolist(), close.tolist(), strict=True)) == expected
    pairs = [sum(bits[i] and not bits[i + 1] for i in range(a, b)) for a, b in list(expected.items())[:300]]
    keys = np.array(list(expected)[:300])
    assert tree.leaf_rank(keys, np.array([expected[k] for k in keys.tolist()])).tolist() == pairs
